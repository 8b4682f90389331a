"""Per-candle series models M4 (returns) and M5 (trend).

One plan at every size: see :mod:`candlewick.operators.sliced`. It spreads a
symbol's history over many tasks and carries what crosses their boundaries in
a small table. ``strategy="window"`` is the reference's form, windows partitioned
by ``symbol`` (a symbol's whole history in one task); it is kept to compare with.

Semantics (SURVEY T1-T3): rows are ordered by ``open_time_ts``, ties by
``close_price``, for LAG, ROW_NUMBER and the ROWS frames; the EMA sums use the default RANGE frame
ordered by ``date``, so all candles of a day are peers and share one EMA.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.arith import safe_divide
from candlewick.functions.time import trade_date

# EMA decay rates of the two trend averages and the SMA lengths.
EMA_RATES = {"ema_7": 0.2, "ema_30": 0.07}
SMA_ROWS = {"sma_7": 7, "sma_30": 30}

STRATEGIES = ("sliced", "window")


def _is_sliced(strategy: str) -> bool:
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; use one of {STRATEGIES}")
    return strategy == "sliced"


def returns_columns(close: str, prev_close: str, first_close: str) -> list:
    return [
        (safe_divide(F.col(close) - F.col(prev_close), F.col(prev_close)) * 100)
        .alias("daily_return"),
        ((safe_divide(F.col(close), F.col(first_close)) - 1) * 100).alias("cumulative_return"),
    ]


def ema_weight(rate: float, row_num: str = "row_num"):
    """Weight EXP(-rate * (row_num - 1)) of the reference's EMA sums."""
    return F.exp(F.lit(-rate) * (F.col(row_num) - 1))


def market_returns(klines: DataFrame, strategy: str = "sliced") -> DataFrame:
    """M4: change vs the previous candle and vs the symbol's first candle, in %."""
    if _is_sliced(strategy):
        from candlewick.operators.sliced import market_returns_sliced

        return market_returns_sliced(klines)
    w = Window.partitionBy("symbol").orderBy("open_time_ts", "close_price")
    return klines.select(
        trade_date("open_time_ts").alias("date"), "symbol", "close_price",
        F.first("close_price").over(w).alias("first_close_price"),
        F.lag("close_price").over(w).alias("previous_close_price"),
    ).select("date", "symbol",
             *returns_columns("close_price", "previous_close_price", "first_close_price"))


def market_trend(klines: DataFrame, strategy: str = "sliced") -> DataFrame:
    """M5: 7/30-candle simple averages and the reference's two EMA-style averages."""
    if _is_sliced(strategy):
        from candlewick.operators.sliced import market_trend_sliced

        return market_trend_sliced(klines)
    by_time = Window.partitionBy("symbol").orderBy("open_time_ts", "close_price")
    by_date = Window.partitionBy("symbol").orderBy("date")  # default RANGE frame: day peers
    numbered = klines.select(
        trade_date("open_time_ts").alias("date"), "symbol", "close_price",
        F.row_number().over(by_time).alias("row_num"), "open_time_ts",
    )
    sma = {name: F.avg("close_price").over(by_time.rowsBetween(-(n - 1), 0)).alias(name)
           for name, n in SMA_ROWS.items()}
    ema = {
        name: (F.sum(F.col("close_price") * ema_weight(rate)).over(by_date)
               / F.sum(ema_weight(rate)).over(by_date)).alias(name)
        for name, rate in EMA_RATES.items()
    }
    return numbered.select("date", "symbol", sma["sma_7"], sma["sma_30"],
                           ema["ema_7"], ema["ema_30"])
