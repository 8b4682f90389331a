"""Time functions: F1 DATE(ts), F2/F3 TIMESTAMP_MILLIS(CAST(x AS INT64)), S23."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def trade_date(ts: Column | str = "open_time_ts") -> Column:
    """UTC calendar day of a timestamp (session zone must be UTC)."""
    return F.to_date(F.col(ts) if isinstance(ts, str) else ts)


def ts_from_millis(ms: Column | str) -> Column:
    """Epoch milliseconds -> timestamp, keeping the millisecond part."""
    col = F.col(ms) if isinstance(ms, str) else ms
    return F.timestamp_millis(col.cast("bigint"))


def fill_timestamps(df: DataFrame, pairs=(("open_time", "open_time_ts"),
                                            ("close_time", "close_time_ts"))) -> DataFrame:
    """Where *either* timestamp is null, recompute **both** from epoch ms.

    Rows with both timestamps present keep them unchanged, as the reference's
    UPDATE ... WHERE a IS NULL OR b IS NULL does. Missing timestamp columns
    are added (all null) first, so freshly landed rows get both filled.
    """
    for _, ts in pairs:
        if ts not in df.columns:
            df = df.withColumn(ts, F.lit(None).cast("timestamp"))
    stale = None
    for _, ts in pairs:
        test = F.col(ts).isNull()
        stale = test if stale is None else (stale | test)
    return df.withColumns({
        ts: F.when(stale, ts_from_millis(ms)).otherwise(F.col(ts)) for ms, ts in pairs
    })
