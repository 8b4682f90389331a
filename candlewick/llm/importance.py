"""Target-distribution importance resampling of documents.

Features are all runs of one or two words, hashed to buckets by CRC-32
(``crc_features``). The gain of a bucket is the scaled logarithm of its smoothed
share in the target over its share in the source; a document's weight is the
floored mean gain of its features. Adding Gumbel noise that depends on the seed
and the id alone and keeping the highest scores draws documents without
replacement, in proportion to their weights, the same ones in every run.

Scale: the texts are read twice (counts, weights) and never shuffled. A task
sends one row per bucket it met; the driver holds ``buckets`` counts. Ranks come
from one range shuffle of the scored rows (ids and numbers): its sort order
includes the row's place in the stored table, so equal scores, a repeated id or
null ids are split like any other rows, and the only window runs over one row
per partition.

Defined results: a null or empty text has no features and weight 0; null
``doc_id`` hashes as an empty string and ranks behind equal scores with an id;
repeated rows are drawn each; an empty table gives no rows; no target text gives
equal shares to all buckets; other input columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import stored, text_or_empty
from candlewick.llm.crc_features import text_slices, word_features


def _count(buckets: int):
    def run(batches: Iterator):
        import pyarrow as pa

        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, data, offsets in text_slices(batch.column(0)):
                total += np.bincount(word_features(data, offsets, buckets)[2], minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met])], names=["bucket", "n"])

    return run


def bucket_counts(docs: DataFrame, buckets: int = 10_000, text_col: str = "text") -> DataFrame:
    """Features of all texts by bucket: bucket, n (buckets without features are absent)."""
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (texts.mapInArrow(_count(buckets), "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(source: DataFrame, target: DataFrame, buckets: int = 10_000) -> list[int]:
    """Gain of each bucket from two tables of :func:`bucket_counts` (at most ``buckets`` rows each)."""
    s, t = ({r["bucket"]: r["n"] for r in counts.collect()} for counts in (source, target))
    all_s, all_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    return [math.floor(1000 * math.log((t.get(b, 0) + 1.0) * all_s / ((s.get(b, 0) + 1.0) * all_t)))
            for b in range(buckets)]


def _weigh(gain: list[int]):
    gain_of = np.array(gain, dtype=np.int64)

    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            words, features, weights = [], [], []
            for _, data, offsets in text_slices(batch.column(1)):
                n_words, text, bucket = word_features(data, offsets, len(gain_of))
                n = np.bincount(text, minlength=len(n_words))
                total = np.zeros(len(n_words), dtype=np.int64)
                np.add.at(total, text, gain_of[bucket])
                words.append(n_words)
                features.append(n)
                weights.append(total // np.maximum(n, 1))
            numbers = [pa.array(np.concatenate(x).astype(np.int64) if x else [], pa.int64())
                       for x in (words, features, weights)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    return run


def weights(docs: DataFrame, gain: list[int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight of every row."""
    return text_or_empty(docs, id_col, text_col).mapInArrow(
        _weigh(gain), "doc_id long, n_words long, n_features long, weight long")


def with_score(weighted: DataFrame, seed: int = 7) -> DataFrame:
    """``weighted`` with its Gumbel score."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weighted.withColumn("score", F.col("weight") + noise)


def ordered(scored: DataFrame, min_words: int) -> DataFrame:
    """``scored`` by eligibility, score and id, written once, with ``at``: partition << 33 | place in it.

    Both tables are written because Spark would otherwise rebuild the range
    shuffle, whose bounds are sampled, for each use.
    """
    rows = stored(scored.withColumn("eligible", F.col("n_words") >= min_words), "scored")
    order = [F.col("eligible").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(),
             "weight", "n_features", "row"]
    return stored(rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order)
                  .sortWithinPartitions(*order).drop("row")
                  .withColumn("at", F.monotonically_increasing_id()), "ranked")


def draw(scored: DataFrame, percent: int = 25, min_words: int = 20) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, ... by descending score, then ascending id, for ``percent`` of
    the documents with at least ``min_words`` words; null for all others."""
    placed = ordered(scored, min_words)
    part = F.shiftrightunsigned("at", 33)
    parts = placed.groupBy(part.alias("part")).agg(
        F.count("*").alias("n"), F.count_if("eligible").alias("eligible"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    all_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
                         F.floor(F.sum("eligible").over(all_parts) * percent / 100).alias("drawn"))
    place = F.col("base") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    return (placed.withColumn("part", part).join(F.broadcast(parts), "part")  # one row per shuffle partition
            .withColumn("rank", F.when(place <= F.col("drawn"), place))
            .drop("part", "at", "base", "drawn", "eligible"))


def resample(docs: DataFrame, target: DataFrame, buckets: int = 10_000, percent: int = 25, min_words: int = 20,
             seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of ``docs``, drawn towards ``target``."""
    gain = gains(bucket_counts(docs, buckets, text_col), bucket_counts(target, buckets, text_col), buckets)
    return draw(with_score(weights(docs, gain, id_col, text_col), seed), percent, min_words)
