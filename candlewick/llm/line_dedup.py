"""Line dedup: documents probe a sharded minimal perfect hash of line hashes.

Steps:

1. every document gives its distinct line keys' 128-bit hashes; a combinable
   aggregate makes one row per distinct line (first document, count);
2. lines are dealt to shards by hash; each shard is indexed by a minimal perfect
   hash with fingerprint, count and first-document arrays, one file per shard in
   the shared folder (``keys_per_shard`` bounds a shard's memory);
3. documents probe the arrays: one probe row per slice of documents and line
   (so a line that a third of all documents hold is a row per slice, not per
   document) goes to the task that has its shard open, and only lines to be
   dropped come back, as line numbers of a document;
4. documents are joined to their dropped line numbers and rebuilt.

A key is a line stripped of white space and lower-cased (A-Z). Keys of at least
``min_chars`` code points in two documents or more lose all lines but those of
the smallest doc_id that holds them.

Defined results: null or empty text is one empty line; rows with the same doc_id
are one document; rows without one are told apart by their texts (equal ones are
one document) and come after all ids, ordered by 60 bits of the text's SHA-256;
an empty table gives no rows; ``deduplicated`` returns the input's columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import file_system, scratch, stored
from candlewick.llm.line_index import LineIndex

STRIP = b" \t\n\x0b\x0c\r"
SLICE_BYTES = 4_000_000


def line_keys(text: bytes, min_chars: int) -> dict[bytes, list[int]]:
    """Hash of each long enough key -> its line numbers. Keys are hashed as UTF-8."""
    import xxhash

    found: dict[bytes, list[int]] = {}
    for i, line in enumerate(text.split(b"\n")):
        key = line.strip(STRIP).lower()
        if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
            found.setdefault(xxhash.xxh3_128_digest(key), []).append(i)
    return found


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _each_line(min_chars: int):
    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            digests, ids, missing = [], [], []
            for doc_id, no_id, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                keys = line_keys(text, min_chars)
                digests += keys
                ids += [doc_id] * len(keys)
                missing += [no_id] * len(keys)
            if digests:
                high, low = _halves(digests)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(high), pa.array(low), pa.array(ids, pa.int64()), pa.array(missing, pa.bool_())],
                    names=["high", "low", "doc_id", "missing"])

    return run


def _build(folder: str):
    def run(pdf):
        import uuid

        import pandas as pd

        shard = int(pdf["shard"].iloc[0])
        index = LineIndex.build(*(pdf[c].to_numpy(np.int64, copy=True) for c in ("high", "low", "count", "first")),
                                named=pdf["named"].to_numpy(bool))
        system, base = file_system(folder)
        system.create_dir(base, recursive=True)
        draft = f"{base}/_draft-{shard}-{uuid.uuid4().hex}"
        with system.open_output_stream(draft, compression=None) as out:
            out.write(index.dump())
        system.move(draft, f"{base}/shard-{shard}.npz")  # a repeated task replaces it with the same lines
        return pd.DataFrame({"shard": [shard], "lines": [len(pdf)]})

    return run


def _probes(min_chars: int, shards: int):
    """One row per slice of documents and distinct line: the holders, packed as (row, line numbers)."""

    def rows(held: dict[bytes, list[tuple]], schema):
        import pyarrow as pa

        high, low = _halves(list(held))
        holders = list(held.values())
        return pa.RecordBatch.from_arrays(
            [pa.array((high.view(np.uint64) % np.uint64(shards)).astype(np.int64)), pa.array(high), pa.array(low),
             *(pa.array([[h[i] for h in hs] for hs in holders], schema.field(name).type)
               for i, name in enumerate(("ids", "missing", "keys", "at")))], schema=schema)

    def run(batches: Iterator):
        import pyarrow as pa

        schema = pa.schema([("shard", pa.int64()), ("high", pa.int64()), ("low", pa.int64()),
                            ("ids", pa.list_(pa.int64())), ("missing", pa.list_(pa.bool_())),
                            ("keys", pa.list_(pa.int64())),
                            ("at", pa.list_(pa.list_(pa.int32())))])
        held, seen, size = {}, set(), 0
        for batch in batches:
            for doc_id, missing, text, key in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (doc_id, missing, key) in seen:
                    continue  # a copy in this slice loses the same lines
                seen.add((doc_id, missing, key))
                for digest, lines in line_keys(text, min_chars).items():
                    held.setdefault(digest, []).append((doc_id, missing, key, lines))
                size += len(text)
                if size >= SLICE_BYTES and held:
                    yield rows(held, schema)
                    held, seen, size = {}, set(), 0
        if held:
            yield rows(held, schema)

    return run


def _dropped(folder: str):
    """Probe rows, ordered by shard, against the shard's arrays: lines to drop, by document."""

    def run(batches: Iterator):
        import pyarrow as pa

        system, base = file_system(folder)
        open_shard, index = None, None
        for batch in batches:
            shard = batch.column(0).to_numpy()
            high, low = (batch.column(i).to_numpy().copy() for i in (1, 2))
            holders = [batch.column(i).to_pylist() for i in (3, 4, 5, 6)]
            out = ([], [], [], [])
            for s in np.unique(shard).tolist():
                if s != open_shard:
                    with system.open_input_file(f"{base}/shard-{s}.npz") as source:
                        index, open_shard = LineIndex.load(source.read()), s
                mine = np.flatnonzero(shard == s)
                cell = index.find(high[mine], low[mine])
                repeated = (cell >= 0) & (index.parts["count"][np.maximum(cell, 0)] > 1)
                where = cell[repeated]
                for i, first, named in zip(mine[repeated].tolist(), index.parts["first"][where].tolist(),
                                           index.parts["named"][where].tolist()):
                    for holder in zip(*(x[i] for x in holders)):
                        if holder[0] != first or holder[1] == named:  # not the first document
                            for column, value in zip(out, holder):
                                column.append(value)
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.bool_()), pa.array(out[2], pa.int64()),
                     pa.array(out[3], pa.list_(pa.int32()))], names=["id", "missing", "key", "lines"])

    return run


def line_index(keyed: DataFrame, min_chars: int = 10, keys_per_shard: int = 250_000) -> tuple[str, int]:
    """(folder, number of shards) of the index over the lines of ``keyed`` (doc_id, missing, text as binary)."""
    given, other = (F.when(F.col("missing") == x, F.col("doc_id")) for x in (False, True))
    two = (F.col("first_id") != F.col("last_id")) | (F.col("first_other") != F.col("last_other")) \
        | (F.col("first_id").isNotNull() & F.col("first_other").isNotNull())
    lines = stored(
        keyed.select("doc_id", "missing", "text")
        .mapInArrow(_each_line(min_chars), "high long, low long, doc_id long, missing boolean")
        .groupBy("high", "low").agg(F.min(given).alias("first_id"), F.max(given).alias("last_id"),
                                    F.min(other).alias("first_other"), F.max(other).alias("last_other"),
                                    F.count("*").alias("n"))
        .select("high", "low", F.coalesce("first_id", "first_other").alias("first"),
                F.col("first_id").isNotNull().alias("named"),
                F.when(F.coalesce(two, F.lit(False)), F.col("n")).otherwise(1).alias("count")),
        "distinct-lines")
    shards = max(1, -(-lines.count() // keys_per_shard))
    folder = scratch(keyed.sparkSession, "line-index")
    # unsigned remainder, as in the probes: the upper 32 bits first, then the lower
    shard = F.expr(f"((shiftrightunsigned(high, 32) % {shards}) * {(1 << 32) % shards} + (high & 4294967295L)) % {shards}")
    stored(lines.withColumn("shard", shard).groupBy("shard")
           .applyInPandas(_build(folder), "shard long, lines long"), "line-shards")
    return folder, shards


def dropped_lines(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  keys_per_shard: int = 250_000) -> DataFrame:
    """(id, missing, key, dropped): numbers of the lines that each document loses; see ``_keyed``."""
    keyed = _keyed(docs, id_col, text_col).withColumn("text", F.col("text").cast("binary")) \
        .select("doc_id", "missing", "text", "key")
    folder, shards = line_index(keyed, min_chars, keys_per_shard)
    probes = keyed.mapInArrow(_probes(min_chars, shards),
                              "shard long, high long, low long, ids array<long>, missing array<boolean>, "
                              "keys array<long>, at array<array<int>>")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # shards are dealt to tasks; a task has one open at a time
    lost = (probes.repartition(n, "shard", F.pmod("low", F.lit(8))).sortWithinPartitions("shard")
            .mapInArrow(_dropped(folder), "id long, missing boolean, key long, lines array<int>"))
    # copies in several slices lose the same lines: they meet before a document's lines are collected
    return (lost.groupBy("id", "missing", "key", "lines").agg(F.lit(1))
            .groupBy("id", "missing", "key").agg(F.flatten(F.collect_list("lines")).alias("dropped")))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows as a struct ``row`` with text, ``key`` (its xxhash64), ``doc_id`` and ``missing``: without an
    id, ``doc_id`` is the text's place among such rows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    place = F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")
    doc_id = F.col(id_col).cast("long")
    return docs.select(F.struct("*").alias("row"), text.alias("text"), F.xxhash64(text).alias("key"),
                       F.when(doc_id.isNull(), place).otherwise(doc_id).alias("doc_id"), doc_id.isNull().alias("missing"))


def deduplicated(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text",
                 keys_per_shard: int = 250_000) -> DataFrame:
    """Every row as a struct ``row`` with id_col as doc_id, ``n_lines``, ``n_dropped`` and ``kept`` (the text left)."""
    lost = dropped_lines(docs, min_chars, id_col, text_col, keys_per_shard)
    rows = _keyed(docs, id_col, text_col).withColumnRenamed("doc_id", "id")
    return (rows.join(lost, ["id", "missing", "key"], "left")
            .withColumn("lines", F.split("text", "\n"))
            .select("row", F.col("row")[id_col].cast("long").alias("doc_id"),
                    F.size("lines").cast("long").alias("n_lines"),
                    F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                    F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.expr(
                        "array_join(transform(array_except(sequence(0, size(lines) - 1), dropped), "
                        "i -> lines[i]), '\n')")).alias("kept")))
