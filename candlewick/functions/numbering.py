"""Row numbers over a whole table without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.session import write_once

_PLACE_BITS = 33


def placed(df: DataFrame, order: list[Column | str], folder: str, parts: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, written once to ``folder``, with ``part`` and
    ``pos``: (part, pos) is the total order. The row's number in the scan breaks the last ties, so
    equal keys are cut like any others. A range shuffle samples its bounds; because its outcome is
    stored with the rows, everything that reads the table agrees on it."""
    keys = [*order, "_row"]
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(parts, *keys) if parts else rows.repartitionByRange(*keys)
    rows = rows.sortWithinPartitions(*keys).drop("_row").withColumn("_at", F.monotonically_increasing_id())
    return write_once(rows.select(
        *df.columns, F.shiftrightunsigned("_at", _PLACE_BITS).alias("part"),
        F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1).alias("pos")), folder)


def with_row_index(df: DataFrame, order: list[Column | str], folder: str) -> DataFrame:
    """``df`` with ``index`` (0, 1, ...) in the given order. The only window runs over one row per partition."""
    rows = placed(df, order, folder)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy("part").count().select(
        "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    return rows.join(bases, "part").withColumn("index", F.col("_base") + F.col("pos")).drop("part", "pos", "_base")
