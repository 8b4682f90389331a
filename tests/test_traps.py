"""Trap fixtures from FIXTURES.md (pages, numbers, paths, timestamps, zero divisors)."""

import json

import pytest
from helpers import klines_df
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from candlewick.functions.paths import landing_path, path_start_ms, symbol_from_path
from candlewick.functions.time import fill_timestamps
from candlewick.operators import daily
from candlewick.sources.landing import latest_file, resume_point
from candlewick.sources.pages import (keep_full_pages, next_cursor, page_start,
                                      parse_kline_pages)


def _candle(t, price="1.5"):
    return [t, price, price, price, price, "2.0", t + 59999, "3.0", 4, "1.0", "1.5", "0"]


def _pages(spark, sizes):
    rows = []
    for page, n in enumerate(sizes):
        body = json.dumps([_candle(1704067200000 + 60000 * (10 * page + i)) for i in range(n)])
        rows.append(("AAA", page, body))
    return spark.createDataFrame(rows, "symbol string, page int, body string")


def test_short_pages_are_not_kept(spark):
    pages = _pages(spark, [3, 3, 1, 0])
    assert parse_kline_pages(pages).count() == 7  # the empty page yields nothing
    assert parse_kline_pages(pages, limit=3).count() == 6
    assert keep_full_pages(pages, 3).count() == 2


def test_parse_types_and_positions(spark):
    row = parse_kline_pages(_pages(spark, [2])).orderBy("pos").collect()[1]
    assert row.pos == 1 and row.open_time == 1704067260000 and row.close_time == 1704067319999
    assert row.open_price == 1.5 and row.number_of_trades == 4 and row.volume == 2.0
    assert "_unused" not in parse_kline_pages(_pages(spark, [1])).columns


def test_bad_number_raises_or_is_null_when_lenient(spark):
    body = json.dumps([_candle(1704067200000, price="x3")])
    pages = spark.createDataFrame([("AAA", 0, body)], "symbol string, page int, body string")
    with pytest.raises(PySparkException):
        parse_kline_pages(pages).collect()
    assert parse_kline_pages(pages, lenient=True).collect()[0].open_price is None


def test_page_start_and_landing_path(spark):
    row = _pages(spark, [2]).select(page_start("body").alias("s")).collect()[0]
    assert row.s == 1704067200000
    path = spark.range(1).select(landing_path(F.lit("BTCBRL"), F.lit(1704164699999))).first()[0]
    assert path == "binance_klines/BTCBRL/2024/M01/BTCBRL_binance_klines_2024-01-02-0304.parquet"


def test_resume_point(spark):
    files = spark.createDataFrame([
        ("A", "binance_klines/A/2023/M12/A_binance_klines_2023-12-31-2359.parquet"),
        ("A", "binance_klines/A/2024/M01/A_binance_klines_2024-01-02-0304.parquet"),
    ], "symbol string, source_file string")
    symbols = spark.createDataFrame([("A",), ("B",)], "symbol string")
    got = {r.symbol: r.start_time for r in resume_point(files, symbols, 1577836800000).collect()}
    assert got == {"A": 1704164640000, "B": 1577836800000}
    latest = latest_file(files).collect()[0]
    assert latest.latest_file.endswith("2024-01-02-0304.parquet")


def test_cursor(spark):
    df = spark.createDataFrame([("A", 0, 5), ("A", 0, 9), ("B", 0, None)],
                               "symbol string, page int, close_time bigint")
    got = {(r.symbol, r.next_start) for r in next_cursor(df, now_ms=1000).collect()}
    assert got == {("A", 10)}
    assert next_cursor(df, now_ms=10).count() == 0  # caught up with the present


def test_half_filled_timestamps_recompute_both(spark):
    df = spark.createDataFrame([
        (60000, 119999, "2030-01-01 00:00:00", None),       # one null -> both recomputed
        (60000, 119999, "2030-01-01 00:00:00", "2030-01-01 00:00:59"),  # kept
        (60000, 119999, None, None),
    ], "open_time bigint, close_time bigint, open_time_ts string, close_time_ts string")
    df = df.withColumns({c: F.to_timestamp(c) for c in ["open_time_ts", "close_time_ts"]})
    got = [(str(r.open_time_ts), str(r.close_time_ts)) for r in fill_timestamps(df).collect()]
    assert got[0] == ("1970-01-01 00:01:00", "1970-01-01 00:01:59.999000")
    assert got[1] == ("2030-01-01 00:00:00", "2030-01-01 00:00:59")
    assert got[2] == got[0]


def test_odd_paths(spark):
    good = "x/binance_klines/AB1/2024/M01/AB1_binance_klines_2024-01-02-0304.parquet"
    df = spark.createDataFrame([(good,), ("x/junk.parquet",)], "p string")
    assert df.select(path_start_ms("p").alias("s")).collect()[1].s is None
    assert df.select(symbol_from_path("p", strict=False).alias("s")).collect()[1].s is None
    assert df.where(F.col("p") == good).select(symbol_from_path("p")).first()[0] == "AB1"
    with pytest.raises(PySparkException, match="cannot extract a symbol"):
        df.select(symbol_from_path("p")).collect()


def test_volatility_zero_open_raises_null_open_is_null(spark):
    zero = klines_df(spark, [("AAA", "2024-01-01 00:00", 0.0, 2.0, 0.0, 1.0, 1.0, 1.0, 1)])
    with pytest.raises(PySparkException, match="DIVIDE_BY_ZERO"):
        daily.market_volatility(zero).collect()
    null = klines_df(spark, [("AAA", "2024-01-01 00:00", None, 2.0, 0.0, 1.0, 1.0, 1.0, 1),
                             ("AAA", "2024-01-01 00:01", 3.0, 2.0, 0.0, 1.0, 1.0, 1.0, 1)])
    assert daily.market_volatility(null).collect()[0].volatility is None


def test_page_builder_cuts_in_time_order(spark):
    """Pages hold a symbol's candles in time order, ``limit`` each, whatever the slices."""
    import json

    from candlewick.sources.events import candles_from_events, read_events
    from candlewick.sources.pages import pages_from_candles

    candles = candles_from_events(read_events(spark, "/root/testdata/sf0.001"))
    times = {}
    for r in candles.select("symbol", "open_time").collect():
        times.setdefault(r[0], []).append(r[1])
    pages = {(r["symbol"], r["page"]): [c[0] for c in json.loads(r["body"])]
             for r in pages_from_candles(candles, 50).collect()}
    want = {(s, i // 50): sorted(t)[i:i + 50] for s, t in times.items() for i in range(0, len(t), 50)}
    assert pages == want and len(pages) > 5
