"""Property: on any history, the sliced plan (with hot-day splitting forced by a
tiny ``slices``) gives exactly the rows of the reference's windows."""

import datetime as dt

from helpers import UTC, klines_df, rounded
from hypothesis import given, settings
from hypothesis import strategies as st

from candlewick.operators import series, sliced

CLOSES = st.one_of(st.none(), st.just(0.0), st.floats(min_value=0.5, max_value=99,
                                                      allow_nan=False).map(lambda x: round(x, 2)))
HISTORY = st.dictionaries(
    keys=st.tuples(st.sampled_from(["AAA", "BBB"]), st.integers(min_value=0, max_value=7 * 1440)),
    values=CLOSES, min_size=1, max_size=120)


@settings(max_examples=6, deadline=None)
@given(HISTORY, st.integers(min_value=1, max_value=9))
def test_sliced_equals_windows(spark, history, slices):
    rows = []
    for (sym, minute), close in history.items():
        t = dt.datetime(2024, 1, 1, tzinfo=UTC) + dt.timedelta(minutes=minute)
        rows.append((sym, t.strftime("%Y-%m-%d %H:%M"), 1.0, 2.0, 0.5, close, 1.0, 1.0, 1))
    k = klines_df(spark, rows)
    for plan, window in ((sliced.market_trend_sliced, series.market_trend),
                         (sliced.market_returns_sliced, series.market_returns)):
        a = rounded(plan(k, slices).collect(), 9)
        b = rounded(window(k, "window").collect(), 9)
        assert a == b
