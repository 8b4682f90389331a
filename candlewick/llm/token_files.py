"""Token-ID files: independent zstandard frames with a trailing seek table.

Layout of a file (every part is a zstandard or skippable frame, so a plain
zstandard decoder reads the id stream):

* data frames: ids as little-endian unsigned 32-bit integers, about
  ``FRAME_IDS`` ids each; a document that would overflow a frame starts a new
  one, and a longer document spans several frames;
* document index (skippable frame): doc_id and number of ids of each document,
  zstandard-compressed;
* seek table (skippable frame): compressed size, raw size and checksum (low 32
  bits of xxHash64 of the raw ids) of each data frame, then a footer.

A reader fetches the two tails, finds the frames that overlap the documents it
wants, and reads, checks and decompresses only those.

Defined results: null or empty text is a document of the end id alone; a null
``doc_id`` sorts first; repeated rows are stored each; an empty table writes no
file; other input columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.llm import bpe
from candlewick.llm.common import file_system, scratch, stored, text_or_empty

# Fixed values of the seekable zstandard format.
SKIPPABLE_SEEK = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
# Ours: the document index is the skippable frame before the seek table.
SKIPPABLE_INDEX = 0x184D2A50
FRAME_IDS = 1 << 16

_FOOTER = struct.Struct("<IBI")
_ENTRY = np.dtype([("packed", "<u4"), ("raw", "<u4"), ("check", "<u4")])
_DOC = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("n", "<u8")])


def _check(raw: bytes) -> int:
    import xxhash

    return xxhash.xxh64(raw).intdigest() & 0xFFFFFFFF


class Writer:
    """Writes one file to ``out`` (an object with ``write``); memory is one frame plus the index."""

    def __init__(self, out, level: int = 1, frame_ids: int = FRAME_IDS):
        import zstandard

        self.out, self.pack, self.limit = out, zstandard.ZstdCompressor(level=level).compress, 4 * frame_ids
        self.buffer, self.held, self.frames, self.docs, self.size = [], 0, [], [], 0

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def _frame(self, raw: bytes) -> None:
        packed = self.pack(raw)
        self.frames.append((len(packed), len(raw), _check(raw)))
        self._write(packed)

    def _flush(self) -> None:
        if self.held:
            self._frame(b"".join(self.buffer))
            self.buffer, self.held = [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id or 0, doc_id is not None, len(ids) // 4))
        if self.held + len(ids) > self.limit:
            self._flush()
        if len(ids) > self.limit:
            for at in range(0, len(ids), self.limit):
                self._frame(ids[at:at + self.limit])
        elif ids:
            self.buffer.append(ids)
            self.held += len(ids)

    def close(self) -> None:
        self._flush()
        index = self.pack(np.array(self.docs, dtype=_DOC).tobytes())
        self._write(struct.pack("<II", SKIPPABLE_INDEX, len(index) + 4) + index + struct.pack("<I", len(index)))
        table = np.array(self.frames, dtype=_ENTRY).tobytes()
        self._write(struct.pack("<II", SKIPPABLE_SEEK, len(table) + _FOOTER.size) + table
                    + _FOOTER.pack(len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC))


class Reader:
    """Random access to one file opened with ``read_at``-style seeking (an Arrow input file)."""

    def __init__(self, source):
        import zstandard

        self.source, self.unpack = source, zstandard.ZstdDecompressor().decompress
        end = source.size()
        count, flags, magic = _FOOTER.unpack(self._at(end - _FOOTER.size, _FOOTER.size))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("not a token file: no seek table at its end")
        table = end - _FOOTER.size - count * _ENTRY.itemsize
        self.frames = np.frombuffer(self._at(table, count * _ENTRY.itemsize), dtype=_ENTRY)
        (size,) = struct.unpack("<I", self._at(table - 12, 4))
        self.docs = np.frombuffer(self.unpack(self._at(table - 12 - size, size)), dtype=_DOC)
        self.frame_at = np.concatenate(([0], np.cumsum(self.frames["packed"], dtype=np.int64)))
        self.frame_raw = np.concatenate(([0], np.cumsum(self.frames["raw"], dtype=np.int64)))
        self.doc_raw = np.concatenate(([0], 4 * np.cumsum(self.docs["n"], dtype=np.int64)))
        self.frames_read = 0
        self._last: tuple[int, bytes] = (-1, b"")

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(int(offset))
        return self.source.read(int(size))

    def _frame(self, k: int) -> bytes:
        if self._last[0] != k:
            raw = self.unpack(self._at(self.frame_at[k], self.frames["packed"][k]))
            if len(raw) != self.frames["raw"][k] or _check(raw) != self.frames["check"][k]:
                raise ValueError(f"checksum of frame {k} does not match")
            self.frames_read += 1
            self._last = (k, raw)
        return self._last[1]

    def ids(self, i: int) -> bytes:
        """Ids of the ``i``-th document; decompresses only the frames it lies in."""
        a, b = int(self.doc_raw[i]), int(self.doc_raw[i + 1])
        out, k = [], int(np.searchsorted(self.frame_raw, a, side="right")) - 1
        while a < b:
            base = int(self.frame_raw[k])
            piece = self._frame(k)[a - base:b - base]
            out.append(piece)
            a, k = a + len(piece), k + 1
        return b"".join(out)

    def doc_id(self, i: int) -> int | None:
        return int(self.docs["doc_id"][i]) if self.docs["has_id"][i] else None


def _write_partition(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator):
        import uuid

        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        system, base = file_system(folder)
        writer = out = None
        end = end_id.to_bytes(4, "little")
        enc = bpe.encoder(tokenizer)
        draft = f"{base}/_draft-{part:06d}-{uuid.uuid4().hex}"
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in bpe.slices(texts):
                for doc_id, got in zip(ids[a:b], enc.encode(texts[a:b])):
                    if writer is None:
                        system.create_dir(base, recursive=True)
                        out = system.open_output_stream(draft, compression=None)
                        writer = Writer(out)
                    writer.add(doc_id, got + end)
        if writer is not None:
            writer.close()
            out.close()
            name = f"part-{part:06d}.ids.zst"
            system.move(draft, f"{base}/{name}")  # a repeated task writes the same bytes again
            tokens = sum(d[2] for d in writer.docs)
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "file": [name], "docs": [len(writer.docs)], "tokens": [tokens],
                 "bytes": [writer.size]},
                pa.schema([("part", pa.int64()), ("file", pa.string()), ("docs", pa.int64()),
                           ("tokens", pa.int64()), ("bytes", pa.int64())]))

    return run


def write_token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 2,
                      id_col: str = "doc_id", text_col: str = "text") -> tuple[str, DataFrame]:
    """Encode all documents and write them in ascending doc_id order, one file per range.

    Returns (folder, manifest); the manifest has one row per file in id order:
    part, file, docs, tokens, bytes, start (ids in all earlier files).
    ``folder`` must be on storage that all executors share; the default is a new
    folder under ``spark.checkpoint.dir``.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark, "token-files")
    # equal ids with different texts get a fixed order; rows equal in both are split by their place in the scan
    order = ["doc_id", "tie", "row"]
    ranged = (text_or_empty(docs, id_col, text_col)
              .withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
              .repartitionByRange(*order).sortWithinPartitions(*order).drop("tie", "row"))
    files = stored(ranged.mapInArrow(_write_partition(folder, tokenizer, end_id),
                                     "part long, file string, docs long, tokens long, bytes long"),
                   "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return folder, files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long")))


def _read_files(folder: str, wanted: frozenset | None):
    def run(batches: Iterator):
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                            ("ids", pa.binary())])
        system, base = file_system(folder)

        def batch(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({n: [r[i] for r in rows] for i, n in enumerate(schema.names)}, schema)

        for name, start in (x for b in batches for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
            with system.open_input_file(f"{base}/{name}") as source:
                reader, rows, size = Reader(source), [], 0
                for i in _positions(reader, wanted):
                    ids = reader.ids(i)
                    rows.append((reader.doc_id(i), start + int(reader.doc_raw[i]) // 4, len(ids) // 4, ids))
                    size += len(ids)
                    if size > 4_000_000:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    return run


def _positions(reader: Reader, wanted: frozenset | None) -> Iterable[int]:
    if wanted is None:
        return range(len(reader.docs))
    hit = np.isin(reader.docs["doc_id"], np.array(sorted(wanted), dtype=np.int64)) & (reader.docs["has_id"] == 1)
    return np.flatnonzero(hit).tolist()


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame,
                     doc_ids: Iterable[int] | None = None) -> DataFrame:
    """Documents of the files: doc_id, start (ids of all documents before it), n_tokens, ids.

    With ``doc_ids``, only the frames holding those documents are read and decompressed.
    """
    wanted = None if doc_ids is None else frozenset(int(d) for d in doc_ids)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (manifest.select("file", "start").repartition(n)
            .mapInArrow(_read_files(folder, wanted), "doc_id long, start long, n_tokens long, ids binary"))
