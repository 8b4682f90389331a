"""Data quality: Q1 ``not_null`` column tests and Q2 the model expectations.

The daily job counts nulls while it writes a model (``DataFrame.observe``), so
checking costs no scan: :class:`ObservedChecks`. Tables that are already there
are checked in one aggregate pass each (``count_if(col IS NULL)`` for all tested
columns at once, then ``unpivot`` to rows), not one query per column:
:func:`run_checks`. The per-symbol staging tests run as a single
``groupBy(symbol)`` pass over the consolidated candles, which equals testing
each per-symbol stage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

# The tested (model, column) pairs.
STAGE_COLUMNS = ["open_time_ts", "close_time_ts"]  # each per-symbol stage
EXPECTATIONS = {
    "stg_klines": ["open_time_ts", "close_time_ts", "symbol"],
    "market_summary": ["date", "symbol", "open_price", "high_price", "low_price",
                       "close_price", "volume", "number_of_trades"],
    "market_volatility": ["date", "symbol", "volatility"],
    "market_trend": ["date", "symbol", "sma_7", "sma_30", "ema_7", "ema_30"],
    "market_liquidity": ["date", "symbol", "liquidity_ratio"],
    "market_returns": ["date", "symbol", "cumulative_return"],
}
STAGE_PREFIX = "stg_klines_"

RESULT_COLUMNS = ["model", "column_name", "failures"]


def not_null(df: DataFrame, columns: list[str], model: str, by: str | None = None) -> DataFrame:
    """(model, column_name, failures) for each column; ``by`` checks each value of
    that column as its own model ``model + value`` in the same pass."""
    counts = [F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    if by is None:
        agg, ids, name = df.agg(*counts), [], F.lit(model)
    else:
        agg, ids, name = df.groupBy(by).agg(*counts), [by], F.concat(F.lit(model), F.coalesce(F.col(by), F.lit("null")))
    long = agg.unpivot(ids, columns, "column_name", "failures")
    return long.select(name.alias("model"), "column_name", "failures")


def run_checks(models: dict[str, DataFrame], expectations: dict | None = None) -> DataFrame:
    """Q2: the not_null tests of every model given (keys as in EXPECTATIONS).

    The consolidated candles (``stg_klines``) also yield the per-symbol stage
    tests ``stg_klines_<SYMBOL>``.
    """
    expectations = EXPECTATIONS if expectations is None else expectations
    parts = []
    for name, df in models.items():
        if name not in expectations:
            continue
        parts.append(not_null(df, expectations[name], name))
        if name == "stg_klines":
            parts.append(not_null(df, STAGE_COLUMNS, STAGE_PREFIX, by="symbol"))
    if not parts:
        raise ValueError("no model with expectations given")
    return reduce(DataFrame.unionByName, parts)


#: Declared grain of the daily models: one row per day and pair.
GRAIN = {m: ["date", "symbol"] for m in ("market_summary", "market_volatility", "market_liquidity")}


def duplicates(df: DataFrame, columns: list[str], model: str) -> DataFrame:
    """(model, keys, failures): how many values of the grain ``columns`` occur more than once. Counts
    are combined before the shuffle, so a hot value is no hot task."""
    rows = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return rows.agg(F.count_if(F.col("_n") > 1).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(",".join(columns)).alias("keys"), "failures")


def run_grain_checks(models: dict[str, DataFrame], grain: dict | None = None) -> DataFrame:
    """Uniqueness of every model that has a declared grain."""
    grain = GRAIN if grain is None else grain
    return reduce(DataFrame.unionByName, [duplicates(df, grain[m], m) for m, df in models.items() if m in grain])


class ObservedChecks:
    """The tests of one model, counted while the model is written.

    Pass ``observed`` and ``metrics`` to the write; after it, ``failures()``
    gives (model, column, failures). For the staged candles the symbols are
    gathered too (one value per pair), and if a stage test can fail -- its
    column has a null anywhere -- ``by_symbol`` says where. A task that runs
    twice may be counted twice: zero stays zero, and any other count fails.
    """

    def __init__(self, model: str):
        self.model, self.observed = model, Observation()
        self.columns = EXPECTATIONS.get(model, [])
        self.metrics = tuple(F.count_if(F.col(c).isNull()).alias(c) for c in self.columns)
        if model == "stg_klines":
            self.metrics += (F.collect_set(F.coalesce("symbol", F.lit("null"))).alias("_symbols"),)

    def failures(self, written: DataFrame, empty: bool = False) -> list[tuple[str, str, int]]:
        """``written`` is read only if a stage test fails. If no row was written (``empty``), the
        observation is not asked: Spark drops it with a plan that turns out to be empty."""
        if not self.metrics:
            return []
        got = {} if empty else self.observed.get
        out = [(self.model, c, got.get(c) or 0) for c in self.columns]
        if self.model == "stg_klines":
            if any(n for _, c, n in out if c in STAGE_COLUMNS):
                out += [tuple(r) for r in not_null(written, STAGE_COLUMNS, STAGE_PREFIX, by="symbol").collect()]
            else:
                out += [(STAGE_PREFIX + s, c, 0) for s in sorted(got.get("_symbols") or []) for c in STAGE_COLUMNS]
        return out


class QualityError(AssertionError):
    pass


def _error(bad: list, n_bad: int) -> QualityError:
    more = f" (and {n_bad - len(bad)} more)" if n_bad > len(bad) else ""
    return QualityError("; ".join(f"{m}.{c}: {n} null" for m, c, n in bad) + more)


def assert_observed(failures: list[tuple[str, str, int]], shown: int = 20) -> int:
    """Fail the job when any observed test has failures; returns the number of tests."""
    bad = sorted(f for f in failures if f[2])
    if bad:
        raise _error(bad[:shown], len(bad))
    return len(failures)


def assert_checks(results: DataFrame, shown: int = 20) -> int:
    """Fail the job when any test has failures; returns the number of tests run.

    Failures are counted on the cluster; only the first ``shown`` failing
    tests come to the driver, for the error message."""
    bad = results.where(F.col("failures") > 0).orderBy("model", "column_name")
    n_bad = bad.count()
    if n_bad:
        raise _error([tuple(r) for r in bad.limit(shown).collect()], n_bad)
    return results.count()


def assert_grain(results: DataFrame) -> int:
    """Fail the job when a model has several rows of one grain; returns the number of tests run."""
    rows = results.collect()  # one per model
    bad = [f"{r['model']}: {r['failures']} values of ({r['keys']}) occur more than once" for r in rows if r["failures"]]
    if bad:
        raise QualityError("; ".join(bad))
    return len(rows)
