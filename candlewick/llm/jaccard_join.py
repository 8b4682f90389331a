"""N-gram Jaccard join by grouped prefixes.

Two documents link when their sets of k-word shingles have a Jaccard similarity
of at least ``percent`` / 100. Ordered by one global order of shingles, linked
documents share a shingle among the first n - ceil(t n) + 1 of each (the prefix).

1. *Order.* Document frequencies of all shingles of all documents are counted by
   32-bit hash. Shingles of one document come first, frequent ones last, so passages
   that documents share stay out of prefixes. Which shingles are repeated is kept in
   a bit table, and the most frequent ones in a list, both of a fixed size; they
   decide about speed only, never about results (any global order is right).
2. *Prefixes.* Shingles that no other document holds use up places of a prefix but
   are not joined.
3. *Groups.* Documents with the same shingle set are one class. Classes with the
   same prefix and size are one group; only groups are joined on prefix shingles.
4. *Verification* compares the shingles of the texts themselves. First each group
   is compared with one group of about its size per shared shingle, and each class
   with one class of its group: enough to connect groups of copies in linear time.
   Then all remaining pairs that share a prefix shingle, pass the size and
   position bounds and lie in different components are expanded and verified, so
   no link between components is lost.

Nothing is enumerated within a component, no group of documents is gathered in
one task, and the driver holds only the two fixed-size tables.

Defined results: null or empty text, or text without words, has an empty set and
links with nothing; shorter texts are one shingle; a null ``doc_id`` counts as
the largest id (null again in the result if nothing smaller is linked); rows with
the same doc_id (or none) and the same text are one document, rows with different
texts are different documents that link by their texts only, so one doc_id may
have several component ids; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import stored
from candlewick.llm.components import components
from candlewick.llm.shingles import shingle_set, shingles

LAST_ID = (1 << 63) - 1   # stands for a null doc_id
BUCKETS = 1024            # of the 32-bit hash space: 4 Mi counters each
CELLS = (1 << 32) // BUCKETS
HOT_LEAST = 16            # documents from which a shingle counts as frequent
HOT_PER_BUCKET = 1024     # the most frequent ones that are listed: 1 Mi in all
FOLD = 5                  # hashes per bit of the table of repeated hashes: 2**5 (16 MB in all)
SLICE_SHINGLES = 2_000_000
PART_ROWS = 500           # rows whose texts are Python objects at once
KNOWN_BYTES = 20_000      # texts whose shingle sets are remembered


def _parts(batches: Iterator) -> Iterator:
    """Short runs of rows of the batches."""
    for batch in batches:
        for at in range(0, batch.num_rows, PART_ROWS):
            yield batch.slice(at, PART_ROWS)


def packed(values: np.ndarray) -> bytes:
    """Sorted cells of a bucket as 16-bit steps; 65535 advances without a value."""
    steps = np.diff(values.astype(np.int64), prepend=0)
    skips = steps // 65535
    out = np.full(len(values) + int(skips.sum()), 65535, dtype="<u2")
    out[np.cumsum(skips) + np.arange(len(values))] = steps % 65535
    return out.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, dtype="<u2")
    return np.cumsum(steps, dtype=np.int64)[steps != 65535]


def _count_slices(k: int):
    """(bucket, cells, repeated): hashes of a slice of documents, one row per bucket.
    ``repeated`` holds (cell, count) for hashes in several documents of the slice."""

    def rows(held: list[np.ndarray]):
        import pyarrow as pa

        values, counts = np.unique(np.concatenate(held), return_counts=True)
        bounds = np.searchsorted(values, np.arange(BUCKETS + 1, dtype=np.int64) * CELLS)
        data = {"bucket": [], "cells": [], "repeated": []}
        for b in range(BUCKETS):
            a, z = bounds[b], bounds[b + 1]
            if a < z:
                cells = values[a:z].astype(np.int64) - b * CELLS
                many = counts[a:z] > 1
                data["bucket"].append(b)
                data["cells"].append(packed(cells))
                data["repeated"].append(np.stack([cells[many], counts[a:z][many]]).astype("<i8").tobytes())
        return pa.RecordBatch.from_pydict(data, pa.schema([("bucket", pa.int64()), ("cells", pa.binary()),
                                                           ("repeated", pa.binary())]))

    def run(batches: Iterator):
        held, size = [], 0
        for part in _parts(batches):
            for text in part.column(0).to_pylist():
                s = shingles(text, k)
                held.append((s >> np.uint64(32)).astype(np.uint32))
                size += len(s)
                if size >= SLICE_SHINGLES:
                    yield rows(held)
                    held, size = [], 0
        if size:
            yield rows(held)

    return run


def _count_buckets(batches: Iterator):
    """Rows ordered by bucket -> (bucket, hot, counts, bits); one bucket's counters are held at a time."""
    import pyarrow as pa

    schema = pa.schema([("bucket", pa.int64()), ("hot", pa.binary()), ("counts", pa.binary()), ("bits", pa.binary())])
    state = {"bucket": None, "count": None}

    def done():
        count = state["count"]
        hot = np.flatnonzero(count >= HOT_LEAST)
        if len(hot) > HOT_PER_BUCKET:
            hot = np.sort(hot[np.argsort(-count[hot].astype(np.int64), kind="stable")[:HOT_PER_BUCKET]])
        bits = np.packbits((count > 1).reshape(-1, 1 << FOLD).any(axis=1), bitorder="little")
        values = (hot + state["bucket"] * CELLS).astype("<u4")
        return pa.RecordBatch.from_pydict(
            {"bucket": [state["bucket"]], "hot": [values.tobytes()],
             "counts": [count[hot].astype("<u4").tobytes()], "bits": [bits.tobytes()]}, schema)

    for batch in batches:
        for bucket, cells, repeated in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if bucket != state["bucket"]:
                if state["bucket"] is not None:
                    yield done()
                state.update(bucket=bucket, count=np.zeros(CELLS, dtype=np.uint32))
            state["count"][unpacked(cells)] += 1
            cell, n = np.frombuffer(repeated, dtype="<i8").reshape(2, -1)
            state["count"][cell] += (n - 1).astype(np.uint32)
    if state["bucket"] is not None:
        yield done()


class Order:
    """The global order of shingles, and which of them are repeated."""

    def __init__(self, rows):
        self.bits = np.zeros((1 << 32 >> FOLD) // 8, dtype=np.uint8)
        size = CELLS >> FOLD >> 3
        hot, counts = [np.zeros(0, "<u4")], [np.zeros(0, "<u4")]
        for r in sorted(rows, key=lambda r: r["bucket"]):
            self.bits[r["bucket"] * size:(r["bucket"] + 1) * size] = np.frombuffer(r["bits"], dtype=np.uint8)
            hot.append(np.frombuffer(r["hot"], dtype="<u4"))
            counts.append(np.frombuffer(r["counts"], dtype="<u4"))
        self.hot, self.counts = np.concatenate(hot), np.concatenate(counts)

    def frequency(self, high: np.ndarray) -> np.ndarray:
        """Listed frequency of each 32-bit hash; 0 if it is not among the frequent ones."""
        if not len(self.hot):
            return np.zeros(len(high), dtype=np.uint32)
        at = np.minimum(np.searchsorted(self.hot, high), len(self.hot) - 1)
        return np.where(self.hot[at] == high, self.counts[at], 0)

    def repeated(self, high: np.ndarray) -> np.ndarray:
        cell = high.astype(np.int64) >> FOLD
        return (self.bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1


def shingle_order(texts: DataFrame, k: int) -> Order:
    """Counts over the shingles of all texts (one binary column)."""
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (texts.mapInArrow(_count_slices(k), "bucket long, cells binary, repeated binary")
            .repartition(n, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(_count_buckets, "bucket long, hot binary, counts binary, bits binary"))
    return Order(rows.collect())  # at most BUCKETS rows, 28 MB in all


def prefix(s: np.ndarray, repeated: np.ndarray, frequency: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that some other document may hold among the first n - ceil(t n) + 1 of a set in the
    global order (unrepeated ones, then infrequent ones by hash, then frequent ones by frequency and
    hash), with their places in that order."""
    n = len(s)
    alone = n - int(repeated.sum())
    left = n - -(-percent * n // 100) + 1 - alone
    if left <= 0:
        return s[:0], np.zeros(0, dtype=np.int32)
    s, frequency = s[repeated], frequency[repeated]
    first = s[np.lexsort((s, frequency))][:left].copy()  # not a view that keeps the whole set
    return first, np.arange(alone, alone + len(first), dtype=np.int32)


def _features(order, k: int, percent: int):
    """Per document: size, class, group and the repeated shingles of its prefix with their places."""

    def run(batches: Iterator):
        import pyarrow as pa
        import xxhash

        table = order.value
        schema = pa.schema([("id", pa.int64()), ("text_key", pa.binary()), ("n", pa.int64()), ("class", pa.binary()),
                            ("group", pa.binary()), ("tokens", pa.list_(pa.int64())), ("places", pa.list_(pa.int32()))])
        for part in _parts(batches):
            out = {name: [] for name in schema.names}
            for doc_id, key, text in zip(*(part.column(i).to_pylist() for i in range(3))):
                s = shingles(text, k)
                high = (s >> np.uint64(32)).astype(np.uint32)
                tokens, places = prefix(s, table.repeated(high), table.frequency(high), percent)
                head = len(s).to_bytes(8, "little")
                for name, value in zip(schema.names, (
                        doc_id, key, len(s), xxhash.xxh3_128_digest(head + s.tobytes()),
                        xxhash.xxh3_128_digest(head + tokens.tobytes()), tokens.view(np.int64), places)):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema)

    return run


def _verify(k: int, percent: int):
    """Pairs with both texts -> pairs that link."""

    def run(batches: Iterator):
        import functools

        import pyarrow as pa

        short = functools.lru_cache(maxsize=256)(lambda text: shingle_set(text, k))
        known = lambda text: short(text) if len(text) < KNOWN_BYTES else shingle_set(text, k)
        for part in _parts(batches):
            a, b, ta, tb = (part.column(i).to_pylist() for i in range(4))
            out = []
            for u, v, x, y in zip(a, b, ta, tb):
                x, y = known(x), known(y)
                common = len(x & y)
                if x and 100 * common >= percent * (len(x) + len(y) - common):
                    out.append((u, v))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in (0, 1)],
                                             names=["u", "v"])

    return run


def _links(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Verified links (u, v) among candidate pairs (u, v) of class numbers."""
    first = texts.select(F.col("node").alias("u"), F.col("text").alias("text_u"))
    second = texts.select(F.col("node").alias("v"), F.col("text").alias("text_v"))
    return (pairs.join(first, "u").join(second, "v").select("u", "v", "text_u", "text_v")
            .mapInArrow(_verify(k, percent), "u long, v long"))


def _key(id_col: str, text_col: str) -> list:
    """What tells documents apart: id and a 128-bit hash of the text."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
            F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))).alias("text_key")]


def _found(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """id, text_key, n and ``least`` (smallest id and text_key of the component, null without shingles) of every row."""
    spark = docs.sparkSession
    keyed = docs.select(*_key(id_col, text_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    order = spark.sparkContext.broadcast(shingle_order(keyed.select("text"), k))  # fixed size
    features = stored(keyed.mapInArrow(_features(order, k, percent),
                                       "id long, text_key binary, n long, class binary, group binary, "
                                       "tokens array<long>, places array<int>"), "shingle-features")

    # one row per class, with a number and its smallest document; one row per group of classes, by its smallest class
    # (numbers in the order of the smallest documents: the centres below are the documents with the least ids)
    classes = stored(
        features.where("n > 0").groupBy("class", "group")
        .agg(F.min(F.struct("id", "text_key")).alias("least"), F.first("n").alias("n"),
             F.first("tokens").alias("tokens"), F.first("places").alias("places")).orderBy("least")
        .select("class", "group", F.monotonically_increasing_id().alias("node"), "least",
                F.col("n").cast("int").alias("n"), "tokens", "places"), "classes")
    joining = classes.where("size(tokens) > 0")  # the others share no shingle of their prefix with any document
    groups = joining.groupBy("group").agg(F.min("node").alias("center"), F.count("*").alias("classes"),
                                          F.first("n").alias("n"), F.first("tokens").alias("tokens"),
                                          F.first("places").alias("places"))
    members = stored(joining.select("group", "node", "least")
                     .join(groups.select("group", "center", "classes"), "group").drop("group"), "group-members")
    # before: the shingle before this one in the prefix, or itself for the first
    blocks = (groups.select("center", "n", "classes", F.explode(F.expr(
        "transform(tokens, (t, i) -> struct(t as token, tokens[greatest(i - 1, 0)] as before, places[i] as place))"))
        .alias("t")).select("center", "n", "classes", "t.*"))
    shared = blocks.groupBy("token").agg(F.sum("classes").alias("k")).where("k > 1").select("token")
    blocks = stored(blocks.join(shared, "token", "left_semi").drop("classes"), "shared-blocks")

    # texts of every class that may be compared: in a shared block, or not alone in its group
    wanted = (members.join(blocks.select("center").distinct().withColumn("shared", F.lit(True)), "center", "left")
              .where("shared or classes > 1").select("node", "least.id", "least.text_key"))
    texts = stored(keyed.join(wanted, ["id", "text_key"]).select("node", "text").dropDuplicates(["node"]), "class-texts")

    # first: a group with one group of its scale per shingle, a class with one class of its group
    scaled = blocks.withColumn("scale", F.floor(F.log("n") / F.log(F.lit(100 / percent))))
    heads = scaled.groupBy("token", "scale").agg(F.min("center").alias("head"), F.count("*").alias("k")).where("k > 1")
    stars = (scaled.join(heads.drop("k"), ["token", "scale"]).where("center <> head")
             .select(F.col("center").alias("u"), F.col("head").alias("v"))
             .union(members.where("node <> center").select("node", "center")).distinct())
    near = stored(_links(stars, texts, k, percent), "star-links")
    known = stored(components(near), "star-components")

    # then: all pairs of a block that are still in different components
    placed = (members.select("center", "node").join(known, "node", "left")
              .select("center", "node", F.coalesce("component", "node").alias("component")))
    spread_out = blocks.join(placed, "center")
    mixed = (spread_out.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b"))
             .where("a < b").select("token"))
    mixed_blocks = stored(spread_out.join(mixed, "token", "left_semi")
                          .select("token", "before", "component", "node", "n", "place"), "mixed-blocks")
    # A pair is wanted at its first common shingle only: members with the same shingle before this one
    # have met there. So parts of a block (component, shingle before) meet parts that differ in both,
    # if the bounds over their members allow a link; then the members of such parts are expanded.
    parts = mixed_blocks.groupBy("token", "before", "component").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("place")).alias("rest"))
    left = parts.toDF("token", "before_u", "a", "least_a", "most_a", "rest_a")
    right = parts.toDF("token", "before_v", "b", "least_b", "most_b", "rest_b")
    meet = (left.join(right, "token")
            .where(f"a < b and (before_u <> before_v or before_u = token)"
                   f" and 100 * most_a >= {percent} * least_b and 100 * most_b >= {percent} * least_a"
                   f" and {100 + percent} * least(rest_a, rest_b) >= {percent} * (least_a + least_b)")
            .select("token", "before_u", "a", "before_v", "b"))
    x = mixed_blocks.toDF("token", "before_u", "a", "u", "n_u", "place_u")
    y = mixed_blocks.toDF("token", "before_v", "b", "v", "n_v", "place_v")
    # overlap needed: percent / (100 + percent) of both sizes; left from a first common shingle at these places
    rest = (meet.join(x, ["token", "before_u", "a"]).join(y, ["token", "before_v", "b"])
            .where(f"100 * least(n_u, n_v) >= {percent} * greatest(n_u, n_v)"
                   f" and {100 + percent} * least(n_u - place_u, n_v - place_v) >= {percent} * (n_u + n_v)")
            .select("u", "v").distinct())
    far = stored(_links(rest, texts, k, percent), "block-links")
    final = components(known.select(F.col("node").alias("u"), F.col("component").alias("v")).union(far))

    named = classes.select("class", "node", "least").join(final, "node", "left").select(
        "class", "least", F.coalesce("component", "node").alias("component"))
    smallest = named.groupBy("component").agg(F.min("least").alias("smallest"))
    named = named.join(smallest, "component").select("class", F.col("smallest").alias("least"))
    return features.select("id", "text_key", "n", "class").join(named, "class", "left").drop("class")


def linked(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of every row."""
    real = lambda i: F.when(i != LAST_ID, i)
    return _found(docs, k, percent, id_col, text_col).select(
        real(F.col("id")).alias("doc_id"), F.col("n").alias("n_shingles"),
        real(F.coalesce("least.id", "id")).alias("component_id"))


def distinct_documents(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One document of each component, with the input's columns: the one with the smallest doc_id (of several
    texts under that id, or of several null ids, the one with the smallest hash of its text). Of rows with the
    same id and text one stays; all rows without words stay."""
    key = ["id", "text_key"]
    marked = stored(_found(docs, k, percent, id_col, text_col).where("n > 0").groupBy(*key)
                    .agg(F.first("least").alias("least"), F.count("*").alias("copies"))
                    .select(*key, (F.struct(*key) == F.col("least")).alias("stays"), "copies")
                    .where("not stays or copies > 1"), "marked-documents")
    # their own small table, so that the rows need no second shuffle if no row is repeated
    repeated = stored(marked.where("stays").select(*key), "repeated-documents")
    rows = docs.select(F.struct("*").alias("row"), *_key(id_col, text_col))
    once = (stored(rows.join(repeated, key, "left_semi"), "repeated-rows")
            .groupBy(*key).agg(F.first("row").alias("row")))
    return rows.join(marked, key, "left_anti").select("row").union(once.select("row")).select("row.*")
