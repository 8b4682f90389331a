"""Bounded samples of texts to learn from.

A text is known by its hash, and a sample holds distinct texts: a document that
is repeated a million times is one text. Which texts are taken depends on their
hashes alone, over all rows; texts themselves move only once they are chosen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import stored

_SCALE = 1 << 30
_SALTS = 64


def text_key(text_col: str = "text"):
    return F.xxhash64(F.col(text_col))


def level(counts: list[int], total: int) -> int:
    """The most to take of each group so that about ``total`` are taken and small groups are whole."""
    left, groups = total, len(counts)
    for n in sorted(counts):
        if n * groups >= left:
            return max(1, left // groups)
        left, groups = left - n, groups - 1
    return max(counts, default=1)


def chosen_keys(keys: DataFrame, by: list[str], most: int | None = None, total: int | None = None) -> DataFrame:
    """(by.., key): about ``most`` distinct keys of each group, or about ``total`` of all groups with the
    small ones whole (``level``; the groups must be few then). ``keys`` has the ``by`` columns and ``key``."""
    distinct = stored(keys.select(*by, "key").distinct(), "sample-keys")
    counts = distinct.groupBy(*by).count()
    if most is None:
        most = level([r["count"] for r in counts.collect()], total)
    place = F.pmod(F.xxhash64(F.lit("sample"), F.col("key")), F.lit(_SCALE))
    # a group may hold most keys: they meet its count in _SALTS places
    counts = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    salted = distinct.withColumn("salt", F.pmod(F.col("key"), F.lit(_SALTS)).cast("int"))
    return (salted.join(counts, [*by, "salt"]).where(place / F.lit(_SCALE) < F.lit(most) / F.col("count"))
            .select(*by, "key"))


def texts_of(rows: DataFrame, chosen: DataFrame, by: list[str], text_col: str = "text") -> DataFrame:
    """(by.., key, text), one row per chosen key. ``rows`` has ``key`` and those of the ``by`` columns
    that should agree; a copy of a text is dropped before the shuffle."""
    on = ["key", *[c for c in by if c in rows.columns]]
    met = rows.select(*on, F.col(text_col).alias("text")).join(F.broadcast(chosen), on)  # bounded by the sample
    return met.groupBy(*by, "key").agg(F.first("text").alias("text"))
