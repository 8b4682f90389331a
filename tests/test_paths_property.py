"""Property tests for the landed-file name."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from candlewick.functions.paths import (landing_path, matches_landing, path_start_ms,
                                        symbol_from_path)

MS = st.integers(min_value=946684800000, max_value=4102444799999)  # years 2000-2099
SYMBOLS = st.text(alphabet="ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", min_size=1, max_size=10)


def expected_path(symbol: str, ms: int) -> str:
    t = dt.datetime.fromtimestamp(ms // 1000, tz=dt.timezone.utc)
    return (f"binance_klines/{symbol}/{t.year}/M{t.month:02d}/"
            f"{symbol}_binance_klines_{t.year}-{t.month:02d}-{t.day:02d}-"
            f"{t.hour:02d}{t.minute:02d}.parquet")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(SYMBOLS, MS), min_size=50, max_size=200))
def test_landing_path_round_trip(spark, rows):
    df = spark.createDataFrame(rows, "symbol string, ms long")
    out = df.select("symbol", "ms", landing_path("symbol", "ms").alias("p")) \
        .select("symbol", "ms", "p", matches_landing("p").alias("ok"),
                symbol_from_path("p").alias("sym"), path_start_ms("p").alias("start")) \
        .collect()
    for r in out:
        assert r.p == expected_path(r.symbol, r.ms)
        assert r.ok and r.sym == r.symbol
        assert r.start == r.ms - r.ms % 60000
