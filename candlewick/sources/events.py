"""Adapter: the driver's ``events`` table -> landed minute candles.

There is no candle table in the test data, so candles are derived from the
``events`` stream the same way in Spark and in the DuckDB oracle: one candle
per (event_type, UTC minute), ``symbol = upper(event_type)``. It is one
grouped aggregate (partial aggregation on the map side), so it scales with
the events table; ``min_by``/``max_by`` give open/close without any sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.session import ensure_utc


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def candles_from_events(events: DataFrame) -> DataFrame:
    """Landed-shape candles (epoch-ms times) plus ``symbol``.

    open/close = value of the first/last event of the minute, high/low =
    max/min value, quote volume = sum of values, trades = event count,
    volume = distinct users; the taker-buy side is taken as half of each
    volume. ``close_time`` is the minute's last millisecond.
    """
    ts = F.col("ts").cast("timestamp")  # NTZ wall clock read as UTC (session zone UTC)
    minute = F.date_trunc("minute", ts)
    agg = (
        events.select(F.upper("event_type").alias("symbol"), ts.alias("ts"),
                      minute.alias("minute"), "value", "user_id")
        .groupBy("symbol", "minute")
        .agg(
            F.min_by("value", "ts").alias("open_price"),
            F.max("value").alias("high_price"),
            F.min("value").alias("low_price"),
            F.max_by("value", "ts").alias("close_price"),
            F.count_distinct("user_id").cast("double").alias("volume"),
            F.sum("value").alias("quote_asset_volume"),
            F.count(F.lit(1)).alias("number_of_trades"),
        )
    )
    open_ms = F.unix_millis("minute")
    return agg.select(
        open_ms.alias("open_time"),
        "open_price", "high_price", "low_price", "close_price", "volume",
        (open_ms + F.lit(59999)).alias("close_time"),
        "quote_asset_volume", "number_of_trades",
        (F.col("volume") / 2).alias("taker_buy_base_asset_volume"),
        (F.col("quote_asset_volume") / 2).alias("taker_buy_quote_asset_volume"),
        "symbol",
    )


def raw_candles(events: DataFrame) -> DataFrame:
    """Candles in raw-table shape (timestamps filled), as a loaded raw table holds them."""
    from candlewick.functions.time import fill_timestamps

    return fill_timestamps(candles_from_events(events))


CANDLES_SQL = """
SELECT epoch_ms(date_trunc('minute', ts)) AS open_time,
       arg_min(value, ts) AS open_price,
       max(value) AS high_price,
       min(value) AS low_price,
       arg_max(value, ts) AS close_price,
       CAST(count(DISTINCT user_id) AS DOUBLE) AS volume,
       epoch_ms(date_trunc('minute', ts)) + 59999 AS close_time,
       sum(value) AS quote_asset_volume,
       count(*) AS number_of_trades,
       CAST(count(DISTINCT user_id) AS DOUBLE) / 2 AS taker_buy_base_asset_volume,
       sum(value) / 2 AS taker_buy_quote_asset_volume,
       upper(event_type) AS symbol
FROM events
GROUP BY upper(event_type), date_trunc('minute', ts)
"""
"""The same adapter for DuckDB, used inside the oracle SQL."""

RAW_CANDLES_SQL = f"""
SELECT *, make_timestamp(open_time * 1000) AS open_time_ts,
       make_timestamp(close_time * 1000) AS close_time_ts
FROM ({CANDLES_SQL})
"""
