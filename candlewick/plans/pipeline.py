"""The daily job -- load, stage, five models, checks -- as one function.

Order as in the reference's workflow: incremental load (S26) -> staging
(P1/M6, materialized, S25) -> not-null checks on staging before anything reads
it (T5) -> models M1-M5 (materialized) -> checks on every model (Q2); a failed
check stops the job with :class:`candlewick.operators.quality.QualityError`.

All tables of a run become visible at once, when its snapshot is committed
(:mod:`candlewick.sinks.models`): a run that fails or stops anywhere leaves the
tables of the run before, and the next run makes up for it. Each written table
is read back by its consumers instead of cached: lineage is cut at every table,
and nothing is pinned in executor memory. The three daily models share one
per-(date, symbol) aggregate, M4, M5 and the state one placing of the candles;
both are written once and deleted at the end.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.paths import symbol_from_path
from candlewick.functions.time import trade_date
from candlewick.operators import daily, series, sliced
from candlewick.operators.ledger import events_after
from candlewick.operators.quality import ObservedChecks, assert_observed
from candlewick.operators.staging import stage_klines
from candlewick.plans.load import LoadResult, load_incremental
from candlewick.schema import RAW_SCHEMA
from candlewick.session import checkpoint_dir, ensure_utc, remove_folder, scratch_dir, write_once
from candlewick.sinks.models import Snapshot, Warehouse, day_name
from candlewick.sources.raw import read_raw

MODELS = ["market_summary", "market_volatility", "market_liquidity", "market_returns",
          "market_trend"]
TABLES = ["stg_klines", *MODELS, "series_state"]


@dataclass
class PipelineResult:
    load: LoadResult
    warehouse: str
    snapshot: int = 0      # number of the snapshot that holds the tables
    checks: int = 0
    tables: list = field(default_factory=list)  # tables that were rewritten


class StoppedForTest(RuntimeError):
    """Raised by ``run_pipeline(..., stop_before=step)``."""


def pending_events(spark: SparkSession, ledger_path: str, consumed: dict[str, int],
                   symbols: list[str] | None = None) -> tuple[DataFrame, int]:
    """(ledger events that the model tables do not reflect yet, number of the last commit).

    ``consumed`` holds the last commit reflected, for all symbols ("") and for those refreshed
    alone since. Only commits after the oldest of these are read."""
    everywhere = consumed.get("", 0)
    events, last = events_after(spark, ledger_path, everywhere)
    symbol = symbol_from_path("source_file")
    done = F.lit(everywhere)
    for name, seq in consumed.items():
        if name:
            done = F.when(symbol == name, F.lit(seq)).otherwise(done)
    events = events.where(F.col("seq") > done)
    if symbols is not None:
        events = events.where(symbol.isin(symbols))
    return events, last


def consumed_after(consumed: dict[str, int], last: int, symbols: list[str] | None) -> dict[str, int]:
    return {"": last} if symbols is None else {**consumed, **{s: last for s in symbols}}


def touched_days(spark: SparkSession, raw_path: str, events: DataFrame) -> list:
    """Days (null among them) of the candles of the given events, as the ledger names them. Only for
    files that were marked without their days, the raw rows are read."""
    days = {r[0] for r in events.select(F.explode("days").alias("d")).select("d.date").distinct().collect()}
    unknown = events.where("days is null").select("load_id", "source_file").distinct()
    if not unknown.isEmpty():
        rows = spark.read.schema(RAW_SCHEMA).parquet(raw_path).select("load_id", "source_file", "date")
        days |= {r[0] for r in rows.join(unknown, ["load_id", "source_file"], "left_semi")
                 .select("date").distinct().collect()}
    return sorted(days, key=day_name)


def on_days(df: DataFrame, days: list) -> DataFrame:
    known = F.col("date").isin([d for d in days if d is not None])
    return df.where(known | F.col("date").isNull() if None in days else known)


def run_pipeline(spark: SparkSession, landing_root: str, warehouse: str,
                 symbols: list[str] | None = None, strategy: str = "sliced",
                 parallelism: int = 4, incremental: bool = False, stop_before: str | None = None) -> PipelineResult:
    """Load, stage, build and check. The models are independent Spark jobs and
    are submitted from ``parallelism`` driver threads (the scheduler interleaves
    their tasks), as the reference's model runner ran four models at a time.

    ``incremental=True`` (once the tables exist) rebuilds only the days with
    loads or withdrawn files that the tables do not reflect yet; raw reads are
    pruned to these days. The snapshot records up to which ledger commit the
    tables go, so a run that stopped anywhere is made up for by the next one,
    and so is a load or an un-marking outside the pipeline. With ``symbols``,
    the other symbols' rows of those days are carried over from the snapshot.

    Staging and M1-M3 are per day, so no other day can change. M4/M5 are
    recomputed from the earliest touched day on: the rest of each symbol's
    history enters through the ``series_state`` table (per symbol-day counts,
    first close, EMA sums) and its last 29 candles. Candles without a time come
    before all others, so a touched null day recomputes M4/M5 whole. Checks run
    on the days that were rewritten."""
    ensure_utc(spark)
    checkpoint_dir(spark)
    raw_path, ledger_path = f"{warehouse}/raw", f"{warehouse}/ledger"

    def step(name: str) -> None:
        if stop_before == name:
            raise StoppedForTest(name)

    loaded = load_incremental(spark, landing_root, raw_path, ledger_path)
    house = Warehouse(spark, warehouse)
    old = house.current()
    refresh = incremental and all(t in old.days for t in TABLES)
    # up to a fixed commit: what is loaded or withdrawn from here on is left to the next run
    pending, last = pending_events(spark, ledger_path, old.consumed if refresh else {}, symbols)
    consumed = consumed_after(old.consumed if refresh else {}, last, symbols)
    days = touched_days(spark, raw_path, pending) if refresh else None
    if refresh and not days:  # nothing new: the tables are current
        if consumed != old.consumed:
            old = house.commit(old, {}, {}, consumed)
        return PipelineResult(loaded, house.root, old.number)
    return _Build(spark, house, old, raw_path, ledger_path, days, symbols, strategy, parallelism, step,
                  consumed).run(loaded)


@dataclass
class _Build:
    """One run's rebuild: ``days`` is None for a full one."""

    spark: SparkSession
    house: Warehouse
    old: Snapshot
    raw_path: str
    ledger_path: str
    days: list | None
    symbols: list[str] | None
    strategy: str
    parallelism: int
    step: Callable[[str], None]
    consumed: dict[str, int]

    def staged(self) -> DataFrame:
        raw = read_raw(self.spark, self.raw_path, self.ledger_path, self.symbols)
        if self.days is None:
            return stage_klines(raw).withColumn("date", trade_date("open_time_ts"))
        raw = on_days(raw, self.days)  # the stored date: only these days' folders are read
        staged = stage_klines(raw).withColumn("date", trade_date("open_time_ts"))
        if self.symbols is None:
            return staged
        kept = on_days(self.house.read("stg_klines", self.old), self.days)
        return staged.unionByName(kept.where(~F.coalesce(F.col("symbol").isin(self.symbols), F.lit(False))))

    def live(self, table: str, written: dict[str, str], rebuilt) -> dict[str, str]:
        """Day -> version of a table after this run: ``rebuilt`` days are only what was written."""
        kept = {} if self.days is None else {
            d: v for d, v in self.old.days[table].items() if not rebuilt(d)}
        return {**kept, **written}

    def write(self, table: str, df: DataFrame, rebalance: bool = True) -> tuple[dict, list]:
        """Write a table's rows; returns (day -> version, its tests)."""
        self.step(table)
        checks = ObservedChecks(table)
        written = self.house.write(table, df, checks.observed if checks.metrics else None, checks.metrics, rebalance)
        return written, checks.failures(self.house.read_days(table, written, df.schema), empty=not written)

    def run(self, loaded: LoadResult) -> PipelineResult:
        touched = {day_name(d) for d in self.days or []}
        staged = self.staged()
        # Raw files each hold one (symbol, day), so staging needs no rebalance.
        written, tests = self.write("stg_klines", staged, rebalance=False)
        checks = assert_observed(tests)
        new = self.house.read_days("stg_klines", written, staged.schema)
        days = {"stg_klines": self.live("stg_klines", written, touched.__contains__)}
        everything = self.house.read_days("stg_klines", days["stg_klines"], staged.schema)

        scratch = scratch_dir(self.spark, "daily")
        day = write_once(daily.daily_aggregates(new.drop("date")), f"{scratch}/day")
        outputs = {"market_summary": daily.summary_from_daily(day),
                   "market_volatility": daily.volatility_from_daily(day),
                   "market_liquidity": daily.liquidity_from_daily(day)}
        start = min(self.days).isoformat() if self.days and None not in self.days else None
        candles, base = everything.drop("date"), None
        if start is not None:
            # M4/M5 from the earliest touched day on, the rest of the history
            # through the stored per-day state (counts, EMA sums, first close).
            candles, base = sliced.refresh_inputs(self.house.read("series_state", self.old), everything, start)
            base = write_once(base, f"{scratch}/base")  # a row per symbol, read by all three
        placed = sliced.place(candles)
        window = self.strategy == "window" and start is None
        outputs["market_returns"] = series.market_returns(candles, "window") if window \
            else sliced.returns_of(placed, base, start)
        outputs["market_trend"] = series.market_trend(candles, "window") if window \
            else sliced.trend_of(placed, base, start)
        outputs["series_state"] = sliced.state_of(placed, base, start)
        with ThreadPoolExecutor(max_workers=max(1, self.parallelism)) as pool:
            jobs = {name: pool.submit(self.write, name, df) for name, df in outputs.items()}
            results = {name: job.result() for name, job in jobs.items()}  # re-raises the first failure
        checks += assert_observed([t for _, tests in results.values() for t in tests])

        def since(d: str) -> bool:
            return start is None or d != day_name(None) and d >= start

        for name, (written, _) in results.items():
            by_day = name in ("market_summary", "market_volatility", "market_liquidity")
            days[name] = self.live(name, written, touched.__contains__ if by_day else since)
        self.step("commit")
        schemas = {n: df.schema.json() for n, df in {"stg_klines": staged, **outputs}.items()}
        snapshot = self.house.commit(self.old, days, schemas, self.consumed)
        placed.remove()
        remove_folder(self.spark, scratch)
        return PipelineResult(loaded, self.house.root, snapshot.number, checks, list(days))
