"""The sliced plan equals the reference's symbol-wide windows (M4, M5)."""

import datetime as dt
import random

import pytest
from helpers import UTC, klines_df, rounded

from candlewick.operators import series
from candlewick.plans.registry import klines


def _random_history(seed, symbols, days, max_per_day):
    rng = random.Random(seed)
    rows = []
    for sym in symbols:
        for d in range(days):
            if rng.random() < 0.2:
                continue  # missing day
            n = rng.choice([1, 1, 2, 3, rng.randint(1, max_per_day)])
            minutes = sorted(rng.sample(range(1440), n))
            for m in minutes:
                t = dt.datetime(2024, 1, 1, tzinfo=UTC) + dt.timedelta(days=d, minutes=m)
                c = rng.choice([0.0, None, round(rng.uniform(1, 100), 2)]) \
                    if rng.random() < 0.05 else round(rng.uniform(1, 100), 2)
                rows.append((sym, t.strftime("%Y-%m-%d %H:%M"), 1.0, 2.0, 0.5, c, 1.0, 1.0, 1))
    return rows


def _same(df_a, df_b, digits=9):
    a, b = rounded(df_a.collect(), digits), rounded(df_b.collect(), digits)
    assert len(a) == len(b)
    assert a == b


def test_long_halo_one_symbol(spark):
    """One symbol, 100 candles over 20 days, most days shorter than the 29-row look-back."""
    rng = random.Random(7)
    rows, left = [], 100
    for d in range(20):
        n = 5 if d < 19 else left
        for i in range(n):
            t = dt.datetime(2024, 1, 1, tzinfo=UTC) + dt.timedelta(days=d, minutes=7 * i)
            rows.append(("AAA", t.strftime("%Y-%m-%d %H:%M"), 1.0, 2.0, 0.5,
                         round(rng.uniform(1, 9), 2), 1.0, 1.0, 1))
        left -= n
    k = klines_df(spark, rows)
    _same(series.market_trend(k, "sliced"), series.market_trend(k, "window"))
    _same(series.market_returns(k, "sliced"), series.market_returns(k, "window"))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_histories(spark, seed):
    k = klines_df(spark, _random_history(seed, ["AAA", "BBB", "CCC"], 60, 80))
    _same(series.market_trend(k, "sliced"), series.market_trend(k, "window"))
    _same(series.market_returns(k, "sliced"), series.market_returns(k, "window"))


def _candle(symbol, time, close, volume=1.0):
    return (symbol, time, 1.0, 2.0, 0.5, close, volume, 1.0, 1)


@pytest.mark.parametrize("slices", [2, 5, 23])
def test_hot_days_are_cut(spark, slices):
    """Any number of slices gives the rows of the windows; days are split when there are more."""
    from candlewick.operators import sliced

    k = klines_df(spark, _random_history(11, ["AAA", "BBB"], 15, 40))
    _same(sliced.market_trend_sliced(k, slices), series.market_trend(k, "window"))
    _same(sliced.market_returns_sliced(k, slices), series.market_returns(k, "window"))


def test_hot_times_null_times_and_copies_are_split(spark):
    """A third of the rows each: one timestamp, no timestamp, exact copies. No run keeps them together,
    and the rows equal the windows (ties in time go by close)."""
    from pyspark.sql import functions as F

    from candlewick.operators import sliced

    rng = random.Random(5)
    rows = [_candle("AAA", f"2024-01-01 00:{m:02d}", round(rng.uniform(1, 9), 2)) for m in range(0, 40, 2)]
    rows += [_candle("AAA", "2024-01-01 00:17", round(rng.uniform(1, 9), 2), float(i)) for i in range(200)]
    rows += [_candle("AAA", "2024-01-01 00:23", 5.0) for _ in range(200)]
    rows += [_candle("AAA", f"2024-01-02 00:{m:02d}", round(rng.uniform(1, 9), 2)) for m in range(12)]
    k = klines_df(spark, rows)
    lost = klines_df(spark, [_candle("AAA", "2024-01-03 00:00", round(rng.uniform(1, 9), 2)) for _ in range(200)])
    k = k.unionByName(lost.withColumn("open_time_ts", F.lit(None).cast("timestamp"))).repartition(3)
    series_of_k = sliced.place(k, slices=16)
    sizes = [r["count"] for r in series_of_k.rows.groupBy(*sliced.KEY).count().collect()]
    assert max(sizes) < 3 * len(rows) / 16 + 30 and sum(sizes) == k.count()
    _same(sliced.trend_of(series_of_k), series.market_trend(k, "window"))
    _same(sliced.returns_of(series_of_k), series.market_returns(k, "window"))
    series_of_k.remove()


def test_null_time_and_symbol_rows_are_kept(spark):
    """Candles with a null time or symbol keep their output rows in both plans."""
    from pyspark.sql import functions as F

    k = klines_df(spark, _random_history(4, ["AAA", "BBB"], 10, 20))
    extra = k.limit(3).withColumn("open_time_ts", F.lit(None).cast("timestamp")) \
        .unionByName(k.limit(2).withColumn("symbol", F.lit(None).cast("string")))
    k = k.unionByName(extra)
    total = k.count()
    for fn in (series.market_trend, series.market_returns):
        sliced_rows = fn(k, "sliced")
        assert sliced_rows.count() == total
        _same(sliced_rows, fn(k, "window"))


def test_test_data(spark):
    k = klines(spark, "/root/testdata/sf0.001")
    _same(series.market_trend(k, "sliced"), series.market_trend(k, "window"))
    _same(series.market_returns(k, "sliced"), series.market_returns(k, "window"))


@pytest.mark.parametrize("reuse,adaptive", [("false", "true"), ("false", "false"), ("true", "false")])
def test_rows_do_not_depend_on_the_optimizer(spark, reuse, adaptive):
    """The order is stored once: without exchange reuse or adaptive execution the rows are the same."""
    from candlewick.operators import sliced

    k = klines(spark, "/root/testdata/sf0.01")
    want = [rounded(f(k, "window").collect(), 9) for f in (series.market_trend, series.market_returns)]
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        for slices in (None, 40):
            got = [rounded(f(k, slices).collect(), 9) for f in (sliced.market_trend_sliced, sliced.market_returns_sliced)]
            assert got == want
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_one_placing_serves_all(spark):
    """M4, M5 and the state of one placing: one range shuffle, which is the placing's own job."""
    from candlewick.operators import sliced

    placed = sliced.place(klines(spark, "/root/testdata/sf0.01"))
    for df in (sliced.trend_of(placed), sliced.returns_of(placed), sliced.state_of(placed)):
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        assert "rangepartitioning" not in df._jdf.queryExecution().executedPlan().toString()
    count = sliced.state_of(placed).agg({"cnt": "sum"}).first()[0]
    assert count == placed.rows.count()
    folder = placed.folder
    placed.remove()
    from candlewick.storage import exists

    assert not exists(spark, folder)


def test_unknown_strategy(spark):
    with pytest.raises(ValueError, match="unknown strategy"):
        series.market_trend(klines(spark, "/root/testdata/sf0.001"), "auto")
