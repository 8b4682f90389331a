"""Packing: bounded-space online packing of documents into fixed-size windows.

Each partition keeps a fixed number of open windows. A document's full windows
are emitted at once; what remains is placed best-fit (the open window with the
least room that still holds it). When it fits nowhere and all windows are in
use, the fullest is emitted, first filled up with the head of the document if
its gap is worth a cut. At the end, the windows still open in neighbouring
partitions are merged: their pieces are laid end to end and cut at the window
size, so a group of partitions leaves one partly filled window.

Memory per task: ``open_windows`` windows plus one slice of texts.

Defined results: null or empty text is a document of the end id alone; null
``doc_id`` stays null; repeated rows are packed each; an empty table gives no
pieces; other input columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import bpe
from candlewick.llm.common import stored, text_or_empty

PIECES = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


class Windows:
    """Open windows of one partition. ``add`` returns the pieces of emitted windows."""

    def __init__(self, size: int, most: int, min_cut: int, first_id: int):
        self.size, self.most, self.min_cut, self.next_id = size, most, min_cut, first_id
        self.room: list[tuple[int, int]] = []          # (free ids, sequence_id), ascending
        self.pieces: dict[int, list[tuple]] = {}

    def _close(self, sequence: int) -> list[tuple]:
        return self.pieces.pop(sequence)

    def _put(self, sequence: int, free: int, doc: tuple, start: int, ids: bytes) -> list[tuple]:
        """Place a piece in a window that holds it; the window is emitted if it is full then."""
        n = len(ids) // 4
        self.pieces.setdefault(sequence, []).append((doc[0], start, n, doc[1], sequence, self.size - free, ids))
        if n == free:
            return self._close(sequence)
        insort(self.room, (free - n, sequence))
        return []

    def add(self, doc_id, ids: bytes) -> list[tuple]:
        n = len(ids) // 4
        doc, out, start = (doc_id, n), [], 0
        while n - start >= self.size:
            out += self._put(self.next_id, self.size, doc, start, ids[4 * start:4 * (start + self.size)])
            self.next_id, start = self.next_id + 1, start + self.size
        if start == n:
            return out
        at = bisect_left(self.room, (n - start, -1))
        if at < len(self.room):
            free, sequence = self.room.pop(at)
            return out + self._put(sequence, free, doc, start, ids[4 * start:])
        if len(self.room) >= self.most:
            free, sequence = self.room.pop(0)
            if free >= self.min_cut:
                out += self._put(sequence, free, doc, start, ids[4 * start:4 * (start + free)])
                start += free
            else:
                out += self._close(sequence)
        self.next_id += 1
        return out + self._put(self.next_id - 1, self.size, doc, start, ids[4 * start:])

    def left(self) -> list[tuple]:
        return [p for _, sequence in self.room for p in self.pieces[sequence]]


def _columns(rows: list[tuple], is_open: bool, part: int) -> dict[str, list]:
    names = ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")
    return {**{n: [r[i] for r in rows] for i, n in enumerate(names)},
            "open": [is_open] * len(rows), "part": [part] * len(rows)}


def _pack_partition(tokenizer: str, end_id: int, size: int, most: int, min_cut: int):
    def run(batches: Iterator):
        import pyarrow as pa
        from pyspark import TaskContext

        schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id",
                                                      "offset")]
                           + [("ids", pa.binary()), ("open", pa.bool_()), ("part", pa.int64())])
        part = TaskContext.get().partitionId()
        windows = Windows(size, most, min_cut, part << 33)
        end = end_id.to_bytes(4, "little")
        enc = bpe.encoder(tokenizer)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in bpe.slices(texts):
                out = []
                for doc_id, got in zip(ids[a:b], enc.encode(texts[a:b])):
                    out += windows.add(doc_id, got + end)
                if out:
                    yield pa.RecordBatch.from_pydict(_columns(out, False, part), schema)
        if left := windows.left():
            yield pa.RecordBatch.from_pydict(_columns(left, True, part), schema)

    return run


def _merge(size: int):
    """Pieces of a group's open windows laid end to end, by partition and window, and cut at ``size``."""

    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["part", "sequence_id", "offset"])
        base = (int(pdf["part"].min()) << 33) + (1 << 32)
        out, at = [], 0
        for doc_id, start, n, total, ids in zip(pdf["doc_id"], pdf["start"], pdf["length"], pdf["doc_tokens"],
                                                pdf["ids"]):
            taken = 0
            while taken < n:
                take = min(n - taken, size - at % size)
                out.append((doc_id, start + taken, take, total, base + at // size, at % size,
                            bytes(ids[4 * taken:4 * (taken + take)])))
                taken, at = taken + take, at + take
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        return pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    return run


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, open_windows: int = 16,
         min_cut: int = 32, merge_partitions: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their ids (little-endian unsigned 32-bit integers).

    One row per piece: doc_id, start and length in the document's ids, doc_tokens,
    sequence_id, offset in the sequence, ids. ``open_windows`` bounds the space,
    ``min_cut`` is the smallest gap worth cutting a document for, and the open
    windows of ``merge_partitions`` consecutive partitions are merged together.
    """
    placed = stored(
        text_or_empty(docs, id_col, text_col).mapInArrow(
            _pack_partition(tokenizer, end_id, window, open_windows, min_cut),
            PIECES + ", open boolean, part long"),
        "packed")
    closed = placed.where(~F.col("open")).drop("open", "part")
    merged = (placed.where("open").withColumn("merge", F.expr(f"part div {int(merge_partitions)}"))
              .groupBy("merge").applyInPandas(_merge(window), PIECES))
    return closed.unionByName(merged)
