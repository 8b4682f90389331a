"""The plan of the per-symbol series models (M4, M5).

The reference's windows are partitioned by ``symbol`` only, so one symbol's
entire history would be one Spark task. Here the candles are put into one total
order (symbol, open time, close price, row of the scan) by a range shuffle and
written once, each row with its part and its position there (:func:`place`).
The parts are of about equal size whatever the data looks like: a hot symbol, a
hot day, thousands of candles at one instant or without a time, and exact
copies are all cut. A *run* is what one part holds of one symbol; there are at
most as many runs as parts and symbols together, and everything that crosses a
run's boundary is carried by that small table:

* global row number = rows of the symbol before the run (running sum of run
  sizes) + position in the run;
* LAG across a boundary = previous run's last close (``lag`` on the run table);
* the symbol's first close = first run's first close;
* the 29-row look-back of the 30-row average: each run receives, as a halo, the
  last rows of the preceding runs that its first rows need. A run may hold fewer
  than 29 candles, so a halo can come from up to 29 earlier runs; only each
  run's last 29 rows are ever candidates, so the halo is bounded;
* EMA (RANGE frame by date): weighted sums per day, a running sum over days,
  joined back by day.

Parts and positions are stored, not recomputed, so every consumer sees the same
ones whatever Spark reuses, coalesces or recomputes; M4, M5 and the state read
one :class:`Placed`. Each needs one more shuffle of the candles (the windows, by
run). Candles with a null symbol or time are kept, as the reference's windows
keep them. Nothing is collected, and nothing is broadcast by hint.

Rows that tie in time are ordered by close price. Rows equal in both are
interchangeable: no output depends on their order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.numbering import placed
from candlewick.functions.time import trade_date
from candlewick.operators.series import EMA_RATES, SMA_ROWS, ema_weight, returns_columns
from candlewick.session import remove_folder, scratch_dir, write_once

NULL_DAY = -(2 ** 31)  # day_key of a null date: sorts first, as NULLS FIRST does
DAY_KEY = ["sym_key", "day_key"]
KEY = ["sym_key", "part"]
ORDER = ["open_time_ts", "close_price"]  # nulls first in both
LOOK_BACK = max(SMA_ROWS.values()) - 1


def _sym_key(symbol) -> F.Column:
    # Non-null and one-to-one: null -> "\0", "X" -> "\1X".
    return F.coalesce(F.concat(F.lit("\u0001"), symbol), F.lit("\u0000"))


def _day_key(date) -> F.Column:
    return F.coalesce(F.unix_date(date), F.lit(NULL_DAY))


def _symbol_of(sym_key) -> F.Column:
    return F.when(sym_key != F.lit("\u0000"), F.substring(sym_key, 2, 1 << 30))


def _date_of(day_key) -> F.Column:
    return F.when(day_key != F.lit(NULL_DAY), F.date_from_unix_date(day_key))


def _base(klines: DataFrame, carry: tuple = ()) -> DataFrame:
    extra = [c for c in carry if c not in ("symbol", "open_time_ts", "close_price")]
    return klines.select(_sym_key(F.col("symbol")).alias("sym_key"),
                         _day_key(trade_date("open_time_ts")).alias("day_key"),
                         "open_time_ts", "close_price", *extra)


def slice_partitions(df: DataFrame) -> int:
    """Parts of the total order: the session's ``spark.sql.shuffle.partitions``."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


@dataclass
class Placed:
    """Candles in their total order, and their runs; two tables below ``folder``."""

    rows: DataFrame   # sym_key, day_key, open_time_ts, close_price, carried columns, part, pos
    runs: DataFrame   # sym_key, part, cnt, first_pos, first_close, last_close
    folder: str

    def remove(self) -> None:
        remove_folder(self.rows.sparkSession, self.folder)


def place(klines: DataFrame, carry: tuple = (), slices: int | None = None) -> Placed:
    """Put candles into their total order, in ``slices`` parts, and store it with its runs (two jobs)."""
    folder = scratch_dir(klines.sparkSession, "series")
    rows = placed(_base(klines, carry), ["sym_key", *ORDER], f"{folder}/rows", slices or slice_partitions(klines))
    runs = rows.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("cnt"), F.min("pos").alias("first_pos"),
        F.min_by("close_price", "pos").alias("first_close"), F.max_by("close_price", "pos").alias("last_close"))
    return Placed(rows, write_once(runs, f"{folder}/runs"), folder)


def run_offsets(series: Placed, base: DataFrame | None = None) -> DataFrame:
    """Per run: ``cnt``, ``first_pos`` and ``start`` (rows of the symbol before the run). ``base``
    (``sym_key``, ``base_rows``) adds rows that precede the input (an incremental refresh)."""
    w = Window.partitionBy("sym_key").orderBy("part")
    before = F.coalesce(F.sum("cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = series.runs
    if base is not None:
        runs = runs.join(base.select("sym_key", "base_rows"), "sym_key", "left")
        before = before + F.coalesce(F.col("base_rows"), F.lit(0))
    return runs.select(*KEY, "cnt", "first_pos", before.alias("start"))


def run_closes(series: Placed) -> DataFrame:
    """Per run: its first position, the previous run's last close and the symbol's first close."""
    w = Window.partitionBy("sym_key").orderBy("part")
    return series.runs.select(
        *KEY, "first_pos", F.lag("last_close").over(w).alias("prev_last_close"),
        F.first("first_close").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .alias("first_close_price"))


def _restore(df: DataFrame) -> DataFrame:
    return df.withColumns({"symbol": _symbol_of(F.col("sym_key")),
                           "date": _date_of(F.col("day_key"))})


def numbered_rows(series: Placed, base: DataFrame | None = None) -> DataFrame:
    """Candles with ``row_num`` = ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY open_time_ts,
    close_price), and their run's ``cnt`` and ``first_pos``: a join with the small run table."""
    return series.rows.join(run_offsets(series, base), KEY).withColumn(
        "row_num", F.col("start") + F.col("pos") - F.col("first_pos") + 1)


def number_rows(klines: DataFrame, carry: tuple = (), slices: int | None = None) -> DataFrame:
    """Candles with ``row_num``, ``symbol``, ``date`` and the ``carry`` columns."""
    return _restore(numbered_rows(place(klines, carry, slices)))


def _since(from_date: str | None):
    """Condition for rows of ``from_date`` and later (all rows if there is none)."""
    return F.lit(True) if from_date is None else F.col("day_key") >= F.unix_date(F.lit(from_date).cast("date"))


def returns_of(series: Placed, base: DataFrame | None = None, from_date: str | None = None) -> DataFrame:
    """M4: LAG inside the run, previous run's last close for a run's first candle.

    Incremental refresh: ``series`` holds the rows from ``from_date`` on plus at
    least the last row before it (context, not emitted); ``base`` gives each
    symbol's ``first_close_price`` from its stored state, null included."""
    closes = run_closes(series)
    if base is not None:
        prior = base.select("sym_key", F.col("first_close_price").alias("_stored_first"),
                            F.lit(True).alias("_has_prior"))
        closes = closes.join(prior, "sym_key", "left").withColumn(
            "first_close_price", F.when(F.col("_has_prior"), F.col("_stored_first"))
            .otherwise(F.col("first_close_price"))).drop("_stored_first", "_has_prior")
    by_pos = Window.partitionBy(*KEY).orderBy("pos")
    rows = series.rows.withColumn("_lag", F.lag("close_price").over(by_pos)).where(_since(from_date))
    rows = _restore(rows.join(closes, KEY)).withColumn(
        "previous_close_price", F.when(F.col("pos") == F.col("first_pos"), F.col("prev_last_close"))
        .otherwise(F.col("_lag")))
    return rows.select("date", "symbol", *returns_columns("close_price", "previous_close_price", "first_close_price"))


def market_returns_sliced(klines: DataFrame, slices: int | None = None) -> DataFrame:
    """M4 of candles that are not placed yet."""
    return returns_of(place(klines, slices=slices))


def halo_sources(runs: DataFrame, look_back: int) -> DataFrame:
    """(source run) -> (``tgt_part``, ``tgt_start``): earlier runs whose rows fall in the
    ``look_back`` rows before the target run's first row."""
    w = Window.partitionBy("sym_key").orderBy("part").rowsBetween(-look_back, -1)
    earlier = F.collect_list(F.struct("part", "start", "cnt")).over(w)
    first_needed = F.col("start") - (look_back - 1)  # 1-based position of the oldest row needed
    return (
        runs.select("sym_key", F.col("part").alias("tgt_part"), F.col("start").alias("tgt_start"),
                    F.filter(earlier, lambda s: s["start"] + s["cnt"] >= first_needed).alias("src"))
        .select("sym_key", "tgt_part", "tgt_start", F.explode("src").alias("s"))
        .select("sym_key", F.col("s.part").alias("part"), "tgt_part", "tgt_start")
    )


EMA_PARTS = [c for name in EMA_RATES for c in (f"{name}_num", f"{name}_den")]


def ema_day_sums(numbered: DataFrame) -> DataFrame:
    """Per (sym_key, day_key): the EMA numerator/denominator sums of the day's
    candles, with weights from their global row numbers."""
    return numbered.groupBy(*DAY_KEY).agg(*[
        agg for name, rate in EMA_RATES.items() for agg in (
            F.sum(F.col("close_price") * ema_weight(rate)).alias(f"{name}_num"),
            F.sum(ema_weight(rate)).alias(f"{name}_den"),
        )
    ])


def trend_of(series: Placed, base: DataFrame | None = None, from_date: str | None = None) -> DataFrame:
    """M5 (same rows as the symbol-wide windows).

    Incremental refresh: ``series`` holds the rows from ``from_date`` on plus
    the last 29 rows before it (context: they fill the first windows but are
    neither emitted nor summed); ``base`` (``sym_key``, ``base_rows`` = rows
    before the context, and the EMA sums of all days before ``from_date``)
    carries the rest of each symbol's history."""
    numbered = numbered_rows(series, base)
    keep = [*KEY, "day_key", "close_price", "row_num"]
    own = numbered.select(*keep, F.lit(False).alias("halo"))
    tail = numbered.where(F.col("pos") >= F.col("first_pos") + F.col("cnt") - LOOK_BACK).select(*keep)
    halo = (
        tail.join(halo_sources(run_offsets(series, base), LOOK_BACK), KEY)
        .where(F.col("row_num") >= F.col("tgt_start") - (LOOK_BACK - 1))
        .select("sym_key", F.col("tgt_part").alias("part"), "day_key", "close_price", "row_num",
                F.lit(True).alias("halo"))
    )
    rows = Window.partitionBy(*KEY).orderBy("row_num")
    sma = own.unionByName(halo).select(
        *DAY_KEY, "halo",
        *[F.avg("close_price").over(rows.rowsBetween(-(n - 1), 0)).alias(name)
          for name, n in SMA_ROWS.items()],
    ).where(~F.col("halo") & _since(from_date))

    per_day = ema_day_sums(numbered.where(_since(from_date)))
    upto = Window.partitionBy("sym_key").orderBy("day_key") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = {c: F.sum(c).over(upto) for c in EMA_PARTS}
    if base is not None:
        per_day = per_day.join(base.select("sym_key", *[F.col(c).alias(f"_prior_{c}")
                                                       for c in EMA_PARTS]), "sym_key", "left")
        # a sum over null closes alone is null: it adds nothing to the sums so far, nor they to it
        running = {c: F.when(running[c].isNull() | F.col(f"_prior_{c}").isNull(),
                             F.coalesce(running[c], F.col(f"_prior_{c}")))
                   .otherwise(running[c] + F.col(f"_prior_{c}")) for c in EMA_PARTS}
    ema_day = per_day.select(*DAY_KEY, *[
        (running[f"{name}_num"] / running[f"{name}_den"]).alias(name) for name in EMA_RATES
    ])
    return sma.join(ema_day, DAY_KEY).select(_date_of(F.col("day_key")).alias("date"),
                                             _symbol_of(F.col("sym_key")).alias("symbol"),
                                             *SMA_ROWS, *EMA_RATES)


def market_trend_sliced(klines: DataFrame, slices: int | None = None) -> DataFrame:
    """M5 of candles that are not placed yet."""
    return trend_of(place(klines, slices=slices))


def state_of(series: Placed, base: DataFrame | None = None, from_date: str | None = None) -> DataFrame:
    """Per (symbol, date): candle count, the day's first close (in row order) and
    the EMA sums with global row numbers -- what an incremental refresh needs of
    the days before it. Same inputs as :func:`trend_of`."""
    numbered = numbered_rows(series, base).where(_since(from_date))
    counts = numbered.groupBy(*DAY_KEY).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.min_by("close_price", "row_num").alias("day_first_close"))
    state = counts.join(ema_day_sums(numbered), DAY_KEY)
    return state.select(_symbol_of(F.col("sym_key")).alias("symbol"),
                        _date_of(F.col("day_key")).alias("date"),
                        "cnt", "day_first_close", *EMA_PARTS)


def refresh_inputs(state: DataFrame, staged: DataFrame, from_date: str,
                   look_back: int = LOOK_BACK) -> tuple[DataFrame, DataFrame]:
    """(candles to recompute, base) for a refresh of M4/M5 from ``from_date``.

    The candles are the staged rows from ``from_date`` on plus, per symbol, the
    last ``look_back`` rows before it. Their days are found on the state table
    and come to the driver (a calendar day is one value), so only these days of
    ``staged`` are read; of each hour at most ``look_back`` rows go to the final
    ranking. ``base`` carries per symbol the rows before the context, the EMA
    sums of the days before ``from_date`` and the first close."""
    d0 = F.lit(from_date).cast("date")
    early = F.col("date").isNull() | (F.col("date") < d0)  # rows without a time come first
    prior = state.where(early)
    later = Window.partitionBy("symbol").orderBy(F.col("date").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    needed = prior.select(F.col("symbol").alias("_s"), F.col("date").alias("_d"),
                          (F.sum("cnt").over(later) - F.col("cnt")).alias("rows_after")) \
        .where(F.col("rows_after") < look_back)
    latest = [F.col(c).desc() for c in ORDER]

    def last(rows: DataFrame, *by) -> DataFrame:
        return rows.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(*latest))) \
            .where(F.col("_k") <= look_back).drop("_k")

    days = [r[0] for r in needed.select("_d").distinct().collect()]
    context_days = F.col("date").isin([d for d in days if d is not None])
    if None in days:
        context_days = context_days | F.col("date").isNull()
    same = F.col("symbol").eqNullSafe(F.col("_s")) & F.col("date").eqNullSafe(F.col("_d"))
    context = last(last(staged.where(context_days).join(needed, same, "left_semi"),
                        "symbol", "date", F.hour("open_time_ts")), "symbol")
    n_context = context.groupBy(_sym_key(F.col("symbol")).alias("sym_key")).agg(F.count(F.lit(1)).alias("n_context"))
    base = (prior.groupBy(_sym_key(F.col("symbol")).alias("sym_key")).agg(
                F.sum("cnt").alias("prior_rows"),
                F.min_by("day_first_close", _day_key(F.col("date"))).alias("first_close_price"),
                *[F.sum(c).alias(c) for c in EMA_PARTS])
            .join(n_context, "sym_key", "left")
            .select("sym_key",
                    (F.col("prior_rows") - F.coalesce("n_context", F.lit(0))).alias("base_rows"),
                    "first_close_price", *EMA_PARTS))
    return context.unionByName(staged.where(F.col("date") >= d0)).drop("date"), base
