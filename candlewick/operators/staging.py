"""Staging (P1) and consolidation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.schema import STAGING_COLUMNS

_CANDLE_COLUMNS = [c for c in STAGING_COLUMNS if c != "symbol"]


def stage_klines(raw: DataFrame, symbol: str | None = None) -> DataFrame:
    """The 11 staging columns plus ``symbol``.

    With ``symbol`` given (the reference's one-model-per-pair form) the rows are
    restricted to that pair and the literal is attached; on the partitioned raw
    table the filter prunes ``symbol=`` directories. Without it the stored
    ``symbol`` column is kept. Epoch-ms and lineage columns are dropped.
    """
    if symbol is None:
        return raw.select(*_CANDLE_COLUMNS, "symbol")
    rows = raw.where(F.col("symbol") == symbol) if "symbol" in raw.columns else raw
    return rows.select(*_CANDLE_COLUMNS, F.lit(symbol).alias("symbol"))


def consolidated_klines(*stages: DataFrame) -> DataFrame:
    """UNION ALL of per-symbol stages (duplicates kept, names aligned)."""
    if not stages:
        raise ValueError("need at least one staged frame")
    return reduce(lambda a, b: a.unionByName(b), [s.select(*STAGING_COLUMNS) for s in stages])
