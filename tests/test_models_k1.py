"""Hand-computed fixture K1 (FIXTURES.md): every model, both plans."""

import datetime as dt

import pytest
from helpers import K1, klines_df, rounded

from candlewick.operators import daily, series
from candlewick.operators.quality import QualityError, assert_checks, run_checks

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


@pytest.fixture(scope="module")
def k1(spark):
    return klines_df(spark, K1)


@pytest.mark.parametrize("strategy", ["aggregate", "window"])
def test_summary(k1, strategy):
    got = rounded(daily.market_summary(k1, strategy).collect())
    assert got == rounded([
        (D1, "AAA", 10.0, 15.0, 9.0, 14.0, 3.0, 5),
        (D2, "AAA", 14.0, 14.0, 7.0, 7.0, 4.0, 0),
        (D1, "BBB", 5.0, 8.0, 4.0, 8.0, 2.0, 0),
    ])


@pytest.mark.parametrize("strategy", ["aggregate", "window"])
def test_volatility(k1, strategy):
    got = rounded(daily.market_volatility(k1, strategy).collect())
    assert got == rounded([(D1, "AAA", 60.0), (D2, "AAA", 50.0), (D1, "BBB", 80.0)])


def test_liquidity(k1):
    got = rounded(daily.market_liquidity(k1).collect())
    assert got == rounded([(D1, "AAA", 7.8), (D2, "AAA", None), (D1, "BBB", None)])


@pytest.mark.parametrize("strategy", ["window", "sliced"])
def test_returns(k1, strategy):
    got = rounded(series.market_returns(k1, strategy).collect())
    assert got == rounded([
        (D1, "AAA", None, 0.0),
        (D1, "AAA", 27.272727, 27.272727),
        (D2, "AAA", -50.0, -36.363636),
        (D1, "BBB", None, None),
        (D1, "BBB", None, None),
    ])


@pytest.mark.parametrize("strategy", ["window", "sliced"])
def test_trend(k1, strategy):
    got = rounded(series.market_trend(k1, strategy).collect())
    assert got == rounded([
        (D1, "AAA", 11.0, 11.0, 12.350498, 12.447521),
        (D1, "AAA", 12.5, 12.5, 12.350498, 12.447521),
        (D2, "AAA", 10.666667, 10.666667, 10.909569, 10.757205),
        (D1, "BBB", 0.0, 0.0, 3.601328, 3.860057),
        (D1, "BBB", 4.0, 4.0, 3.601328, 3.860057),
    ])


def test_checks_report_the_null_outputs(k1):
    models = {
        "stg_klines": k1,
        "market_summary": daily.market_summary(k1),
        "market_volatility": daily.market_volatility(k1),
        "market_liquidity": daily.market_liquidity(k1),
        "market_returns": series.market_returns(k1),
        "market_trend": series.market_trend(k1),
    }
    rows = run_checks(models).collect()
    assert len(rows) == 23 + 3 + 2 * 2  # model columns + consolidated + 2 per symbol stage
    failing = {(r.model, r.column_name): r.failures for r in rows if r.failures}
    assert failing == {("market_liquidity", "liquidity_ratio"): 2,
                       ("market_returns", "cumulative_return"): 2}
    with pytest.raises(QualityError, match="liquidity_ratio: 2 null"):
        assert_checks(run_checks(models))
    assert_checks(run_checks({"market_summary": models["market_summary"]}))


def test_day_based_series_from_the_summary(k1):
    """M4/M5 over M1's output work per day (one row per symbol-day)."""
    days = daily.as_daily_klines(daily.market_summary(k1))
    got = rounded(series.market_returns(days, "window").collect())
    assert got == rounded([(D1, "AAA", None, 0.0), (D2, "AAA", -50.0, -50.0),
                           (D1, "BBB", None, 0.0)])
    trend = rounded(series.market_trend(days, "sliced").collect())
    assert [t[2] for t in trend if t[1] == "AAA"] == [14.0, 10.5]  # sma_7 over days
