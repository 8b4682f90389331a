"""Registered queries: each reads the driver's test tables (``events``), derives
candles from them and runs one operator; each has a DuckDB oracle over the
same parquet views where the operator is expressible in SQL.

Presentation rules shared by both sides (SURVEY T13/T14): doubles are rounded
to 12 significant digits, and timestamps are shown as zone-less UTC wall clock.
Sums of doubles depend on addition order, so the engines may differ in the last
bit; a fixed number of decimals can then split a value lying exactly on a
rounding tie (e.g. a sum divided by 64), while 12 significant digits keeps
ties out of reach for this data. Both engines take the same IEEE steps: an
exact power of ten (10^0..10^22), one multiply or divide, round, undo.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators import daily, series
from candlewick.schema import LANDING_ROOT
from candlewick.sources.events import CANDLES_SQL, RAW_CANDLES_SQL, raw_candles, read_events

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = significant(c)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


DIGITS = 12


def significant(c):
    """Round a double column to DIGITS significant digits."""
    e = F.floor(F.log10(F.abs(c)))
    up = F.pow(F.lit(10.0), F.lit(DIGITS - 1) - e)    # used when e <= DIGITS - 1
    down = F.pow(F.lit(10.0), e - F.lit(DIGITS - 1))  # used when e > DIGITS - 1
    return (F.when(c.isNull() | F.isnan(c) | (c == 0) | (F.abs(c) == float("inf")), c)
            .when(e <= DIGITS - 1, F.round(c * up) / up)
            .otherwise(F.round(c / down) * down))


def significant_sql(x: str) -> str:
    e = f"floor(log10(abs({x})))"
    return (f"CASE WHEN {x} IS NULL OR isnan({x}) OR {x} = 0 OR isinf({x}) THEN {x} "
            f"WHEN {e} <= {DIGITS - 1} THEN round({x} * pow(10.0, {DIGITS - 1} - {e})) "
            f"/ pow(10.0, {DIGITS - 1} - {e}) "
            f"ELSE round({x} / pow(10.0, {e} - {DIGITS - 1})) * pow(10.0, {e} - {DIGITS - 1}) END")


def rounded_sql(inner: str, doubles: list[str]) -> str:
    if not doubles:
        return inner
    repl = ", ".join(f"{significant_sql(d)} AS {d}" for d in doubles)
    return f"SELECT * REPLACE ({repl}) FROM ({inner}) AS q"


def register(name: str, sql: str | None = None, doubles: list[str] | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: present(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = rounded_sql(sql, doubles or [])
        return fn
    return deco


def klines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consolidated candles derived from the driver's events table."""
    return raw_candles(read_events(spark, sf_dir))


K = f"WITH k AS ({RAW_CANDLES_SQL})"
CANDLE_DOUBLES = ["open_price", "high_price", "low_price", "close_price", "volume",
                  "quote_asset_volume", "taker_buy_base_asset_volume",
                  "taker_buy_quote_asset_volume"]

# ---------------------------------------------------------------- adapter / M1-M5


@register("candles_from_events", CANDLES_SQL, CANDLE_DOUBLES)
def q_candles(spark, sf_dir):
    from candlewick.sources.events import candles_from_events

    return candles_from_events(read_events(spark, sf_dir))


def summary_sql(candles: str = K) -> str:
    """SQL over ``k``, which ``candles`` defines."""
    return f"""{candles}
SELECT CAST(open_time_ts AS DATE) AS date, symbol,
       first(open_price ORDER BY open_time_ts) AS open_price,
       max(high_price) AS high_price, min(low_price) AS low_price,
       last(close_price ORDER BY open_time_ts) AS close_price,
       sum(volume) AS volume, CAST(sum(number_of_trades) AS BIGINT) AS number_of_trades
FROM k GROUP BY 1, 2"""
SUMMARY_DOUBLES = ["open_price", "high_price", "low_price", "close_price", "volume"]


@register("market_summary", summary_sql(), SUMMARY_DOUBLES)
def q_summary(spark, sf_dir):
    return daily.market_summary(klines(spark, sf_dir))


@register("market_summary_window", summary_sql(), SUMMARY_DOUBLES)
def q_summary_window(spark, sf_dir):
    return daily.market_summary(klines(spark, sf_dir), strategy="window")


def volatility_sql(candles: str = K) -> str:
    """SQL over ``k``, which ``candles`` defines."""
    return f"""{candles}
SELECT CAST(open_time_ts AS DATE) AS date, symbol,
       (max(high_price) - min(low_price)) / first(open_price ORDER BY open_time_ts) * 100
         AS volatility
FROM k GROUP BY 1, 2"""


@register("market_volatility", volatility_sql(), ["volatility"])
def q_volatility(spark, sf_dir):
    return daily.market_volatility(klines(spark, sf_dir))


@register("market_volatility_window", volatility_sql(), ["volatility"])
def q_volatility_window(spark, sf_dir):
    return daily.market_volatility(klines(spark, sf_dir), strategy="window")


def liquidity_sql(candles: str = K) -> str:
    """SQL over ``k``, which ``candles`` defines."""
    return f"""{candles}
SELECT CAST(open_time_ts AS DATE) AS date, symbol,
       sum(quote_asset_volume) / NULLIF(sum(number_of_trades), 0) AS liquidity_ratio
FROM k GROUP BY 1, 2"""


@register("market_liquidity", liquidity_sql(), ["liquidity_ratio"])
def q_liquidity(spark, sf_dir):
    return daily.market_liquidity(klines(spark, sf_dir))


def returns_sql(candles: str = K) -> str:
    """SQL over ``k``, which ``candles`` defines."""
    return f"""{candles}
SELECT CAST(open_time_ts AS DATE) AS date, symbol,
       (close_price - lag(close_price) OVER w) / NULLIF(lag(close_price) OVER w, 0) * 100
         AS daily_return,
       (close_price / NULLIF(first_value(close_price) OVER w, 0) - 1) * 100
         AS cumulative_return
FROM k
WINDOW w AS (PARTITION BY symbol ORDER BY open_time_ts NULLS FIRST, close_price NULLS FIRST)"""
RETURNS_DOUBLES = ["daily_return", "cumulative_return"]


@register("market_returns", returns_sql(), RETURNS_DOUBLES)
def q_returns(spark, sf_dir):
    return series.market_returns(klines(spark, sf_dir))


SHORT_RUNS = 150


@register("market_returns_sliced", returns_sql(), RETURNS_DOUBLES)
def q_returns_sliced(spark, sf_dir):
    """In many more parts than the session's, so that runs are short and most boundaries are crossed."""
    from candlewick.operators.sliced import market_returns_sliced

    return market_returns_sliced(klines(spark, sf_dir), slices=SHORT_RUNS)


@register("market_returns_window", returns_sql(), RETURNS_DOUBLES)
def q_returns_window(spark, sf_dir):
    return series.market_returns(klines(spark, sf_dir), strategy="window")


def trend_sql(candles: str = K) -> str:
    """SQL over ``k``, which ``candles`` defines."""
    return f"""{candles},
n AS (SELECT CAST(open_time_ts AS DATE) AS date, symbol, open_time_ts, close_price,
             row_number() OVER (PARTITION BY symbol
               ORDER BY open_time_ts NULLS FIRST, close_price NULLS FIRST) AS rn
      FROM k)
SELECT date, symbol,
  avg(close_price) OVER (PARTITION BY symbol ORDER BY open_time_ts NULLS FIRST, close_price NULLS FIRST
                         ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS sma_7,
  avg(close_price) OVER (PARTITION BY symbol ORDER BY open_time_ts NULLS FIRST, close_price NULLS FIRST
                         ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS sma_30,
  sum(close_price * exp(-0.2 * (rn - 1))) OVER d / sum(exp(-0.2 * (rn - 1))) OVER d AS ema_7,
  sum(close_price * exp(-0.07 * (rn - 1))) OVER d / sum(exp(-0.07 * (rn - 1))) OVER d
    AS ema_30
FROM n
WINDOW d AS (PARTITION BY symbol ORDER BY date)"""
TREND_DOUBLES = ["sma_7", "sma_30", "ema_7", "ema_30"]


@register("market_trend", trend_sql(), TREND_DOUBLES)
def q_trend(spark, sf_dir):
    return series.market_trend(klines(spark, sf_dir))


@register("market_trend_sliced", trend_sql(), TREND_DOUBLES)
def q_trend_sliced(spark, sf_dir):
    """As market_returns_sliced; halos come from several earlier runs."""
    from candlewick.operators.sliced import market_trend_sliced

    return market_trend_sliced(klines(spark, sf_dir), slices=SHORT_RUNS)


@register("market_trend_window", trend_sql(), TREND_DOUBLES)
def q_trend_window(spark, sf_dir):
    return series.market_trend(klines(spark, sf_dir), strategy="window")

# ---------------------------------------------------------------- staging, S23, Q1/Q2

def stage_sql(candles: str = K) -> str:
    """SQL over ``k``, which ``candles`` defines."""
    return f"""{candles}
SELECT open_time_ts, close_time_ts, open_price, high_price, low_price, close_price, volume,
       quote_asset_volume, number_of_trades, taker_buy_base_asset_volume,
       taker_buy_quote_asset_volume, symbol
FROM k"""


@register("stage_klines", stage_sql(), CANDLE_DOUBLES)
def q_stage(spark, sf_dir):
    from candlewick.operators.staging import stage_klines

    return stage_klines(klines(spark, sf_dir))


@register("consolidated_klines", stage_sql(), CANDLE_DOUBLES)
def q_consolidated(spark, sf_dir):
    from candlewick.operators.staging import consolidated_klines, stage_klines

    # one raw table with a symbol column: the stage of all pairs is one scan
    return consolidated_klines(stage_klines(klines(spark, sf_dir)))


# Rows in four kinds by minute: both timestamps given (a second late, so that keeping them shows),
# only the first, only the second, none.
HALF_FILLED = {"open_time": (0, 1), "close_time": (0, 2)}


def _given_sql(ms: str) -> str:
    return f"CASE WHEN (open_time // 60000) % 4 = 0 THEN make_timestamp({ms} * 1000 + 1000000) ELSE make_timestamp({ms} * 1000) END"


@register("fill_timestamps", f"""
SELECT open_time, {_given_sql("open_time")} AS open_time_ts,
       close_time, {_given_sql("close_time")} AS close_time_ts, symbol
FROM ({CANDLES_SQL}) AS c""")
def q_fill(spark, sf_dir):
    from candlewick.functions.time import fill_timestamps
    from candlewick.sources.events import candles_from_events

    landed = candles_from_events(read_events(spark, sf_dir))
    kind = F.expr("(open_time div 60000) % 4")
    for ms, kinds in HALF_FILLED.items():
        landed = landed.withColumn(f"{ms}_ts", F.when(kind.isin(*kinds), F.timestamp_millis(F.col(ms) + 1000)))
    return fill_timestamps(landed).select("open_time", "open_time_ts", "close_time",
                                          "close_time_ts", "symbol")


# Every tenth minute has no close price, every fifteenth no close time and no quote volume, so tests fail.
PLANTED = {"close_price": 10, "close_time_ts": 15, "quote_asset_volume": 15}
K_PLANTED = K.replace("WITH k AS", "WITH unplanted AS", 1) + ", k AS (SELECT * REPLACE ({}) FROM unplanted)".format(", ".join(
    f"CASE WHEN minute(open_time_ts) % {n} = 0 THEN NULL ELSE {c} END AS {c}" for c, n in PLANTED.items()))


def _models(spark, sf_dir):
    """The planted candles and all models of them; the daily aggregate and the placing are shared."""
    from candlewick.operators import sliced
    from candlewick.operators.staging import stage_klines
    from candlewick.session import scratch_dir, write_once

    k = stage_klines(klines(spark, sf_dir))
    k = k.withColumns({c: F.when(F.minute("open_time_ts") % n != 0, F.col(c)) for c, n in PLANTED.items()})
    folder = scratch_dir(spark, "checks")
    k = write_once(k, f"{folder}/candles")
    day = write_once(daily.daily_aggregates(k), f"{folder}/days")
    series_of_k = sliced.place(k)
    return {
        "stg_klines": k,
        "market_summary": daily.summary_from_daily(day),
        "market_volatility": daily.volatility_from_daily(day),
        "market_trend": sliced.trend_of(series_of_k),
        "market_liquidity": daily.liquidity_from_daily(day),
        "market_returns": sliced.returns_of(series_of_k),
    }


def _not_null_sql() -> str:
    from candlewick.operators.quality import EXPECTATIONS, STAGE_COLUMNS, STAGE_PREFIX

    sources = {"stg_klines": stage_sql, "market_summary": summary_sql, "market_volatility": volatility_sql,
               "market_trend": trend_sql, "market_liquidity": liquidity_sql, "market_returns": returns_sql}
    sources = {model: sql(K_PLANTED) for model, sql in sources.items()}
    parts = []
    for model, cols in EXPECTATIONS.items():
        for c in cols:
            parts.append(f"SELECT '{model}' AS model, '{c}' AS column_name, "
                         f"count(*) FILTER (WHERE {c} IS NULL) AS failures "
                         f"FROM ({sources[model]}) AS m")
    for c in STAGE_COLUMNS:
        parts.append(f"SELECT '{STAGE_PREFIX}' || symbol AS model, '{c}' AS column_name, "
                     f"count(*) FILTER (WHERE {c} IS NULL) AS failures "
                     f"FROM ({sources['stg_klines']}) AS m GROUP BY symbol")
    return "\nUNION ALL\n".join(parts)


@register("not_null_checks", _not_null_sql())
def q_checks(spark, sf_dir):
    from candlewick.operators.quality import run_checks

    return run_checks(_models(spark, sf_dir))



def _grain_sql() -> str:
    from candlewick.operators.quality import GRAIN

    # every seventh day is there twice, in all but the last model
    parts = []
    for model in GRAIN:
        twice = "SELECT 0 AS n" if model == "market_liquidity" else "SELECT 0 AS n UNION ALL SELECT 1"
        parts.append(f"SELECT '{model}' AS model, 'date,symbol' AS keys, count(*) FILTER (n > 1) AS failures FROM ("
                     f"SELECT date, symbol, count(*) AS n FROM ({summary_sql()}) AS m, ({twice}) AS t "
                     "WHERE t.n = 0 OR day(date) % 7 = 0 GROUP BY 1, 2) AS g")
    return "\nUNION ALL\n".join(parts)


@register("grain_checks", _grain_sql())
def q_grain(spark, sf_dir):
    from candlewick.operators.quality import run_grain_checks

    day = daily.daily_aggregates(klines(spark, sf_dir))
    models = {"market_summary": daily.summary_from_daily(day), "market_volatility": daily.volatility_from_daily(day)}
    twice = {m: df.unionByName(df.where(F.day("date") % 7 == 0)) for m, df in models.items()}
    return run_grain_checks({**twice, "market_liquidity": daily.liquidity_from_daily(day)})

# ---------------------------------------------------------------- pages and landing

PAGE_LIMIT = 100  # request size for the test data (the reference default, 1000, leaves one full page per symbol at sf0.01)
# Present time for the cursor: the test data covers January 2024; extraction runs on Jan 31.
NOW_MS = 1706659200000
# Resume points are asked for the pairs of the data plus one configured pair with no landed file.
UNLANDED_SYMBOL = "BTCBRL"

NUMBERED_SQL = f"""
SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY open_time) AS rn
FROM ({CANDLES_SQL}) AS c"""
PAGED_SQL = f"""
SELECT *, CAST(floor((rn - 1) / {PAGE_LIMIT}) AS INTEGER) AS page,
       CAST(rn - 1 - floor((rn - 1) / {PAGE_LIMIT}) * {PAGE_LIMIT} AS INTEGER) AS pos
FROM ({NUMBERED_SQL}) AS n"""
PAGE_INFO_SQL = f"""
SELECT symbol, page, count(*) AS n_rows, min(open_time) AS page_start
FROM ({PAGED_SQL}) AS p GROUP BY symbol, page"""
LANDING_PATH_SQL = (f"'{LANDING_ROOT}/' || symbol || '/' || "
                    "strftime(make_timestamp(page_start * 1000), '%Y/M%m') || '/' || symbol || "
                    f"'_{LANDING_ROOT}_' || "
                    "strftime(make_timestamp(page_start * 1000), '%Y-%m-%d-%H%M') || '.parquet'")
FULL_PAGES_SQL = f"""
SELECT symbol, page, page_start, {LANDING_PATH_SQL} AS source_file
FROM ({PAGE_INFO_SQL}) AS i WHERE n_rows >= {PAGE_LIMIT}"""


def _pages(spark, sf_dir):
    from candlewick.sources.events import candles_from_events
    from candlewick.sources.pages import pages_from_candles

    return pages_from_candles(candles_from_events(read_events(spark, sf_dir)), PAGE_LIMIT)


def _full_pages(spark, sf_dir):
    from candlewick.sources.pages import keep_full_pages, with_landing_path

    return with_landing_path(keep_full_pages(_pages(spark, sf_dir), PAGE_LIMIT))


@register("parse_kline_pages", f"""
SELECT symbol, page, pos, open_time, open_price, high_price, low_price, close_price, volume,
       close_time, quote_asset_volume, number_of_trades, taker_buy_base_asset_volume,
       taker_buy_quote_asset_volume
FROM ({PAGED_SQL}) AS p""", CANDLE_DOUBLES)
def q_parse_pages(spark, sf_dir):
    from candlewick.sources.pages import parse_kline_pages

    return parse_kline_pages(_pages(spark, sf_dir))


@register("keep_full_pages", f"""
SELECT symbol, page, n_rows FROM ({PAGE_INFO_SQL}) AS i WHERE n_rows >= {PAGE_LIMIT}""")
def q_full_pages(spark, sf_dir):
    from candlewick.sources.pages import keep_full_pages, page_size

    return keep_full_pages(_pages(spark, sf_dir), PAGE_LIMIT) \
        .select("symbol", "page", page_size("body").alias("n_rows"))


@register("page_start", FULL_PAGES_SQL)
def q_page_start(spark, sf_dir):
    return _full_pages(spark, sf_dir).select("symbol", "page", "page_start", "source_file")


@register("landing_path", f"""
SELECT symbol, page, {LANDING_PATH_SQL} AS source_file FROM ({PAGE_INFO_SQL}) AS i""")
def q_landing_path(spark, sf_dir):
    """S7 for every page, short ones included (their name is what would be deleted)."""
    from candlewick.sources.pages import with_landing_path

    return with_landing_path(_pages(spark, sf_dir)).select("symbol", "page", "source_file")


@register("symbol_from_path", f"""
SELECT source_file, regexp_extract(source_file, '{LANDING_ROOT}/([A-Z0-9]+)/', 1) AS symbol
FROM ({FULL_PAGES_SQL}) AS f""")
def q_symbol_from_path(spark, sf_dir):
    from candlewick.functions.paths import symbol_from_path

    return _full_pages(spark, sf_dir).select(
        "source_file", symbol_from_path("source_file").alias("symbol"))


@register("latest_file", f"""
SELECT symbol, arg_max(source_file, page_start) AS latest_file, max(page_start) AS latest_start
FROM ({FULL_PAGES_SQL}) AS f GROUP BY symbol""")
def q_latest_file(spark, sf_dir):
    from candlewick.sources.landing import latest_file

    return latest_file(_full_pages(spark, sf_dir).select("symbol", "source_file"))


@register("resume_point", f"""
SELECT s.symbol, coalesce(l.latest_start, 1577836800000) AS start_time
FROM (SELECT DISTINCT symbol FROM ({PAGED_SQL}) AS p UNION SELECT '{UNLANDED_SYMBOL}') AS s
LEFT JOIN (SELECT symbol, max(page_start) AS latest_start FROM ({FULL_PAGES_SQL}) AS f
           GROUP BY symbol) AS l ON s.symbol = l.symbol""")
def q_resume_point(spark, sf_dir):
    from candlewick.schema import DEFAULT_START_MS
    from candlewick.sources.landing import resume_point

    symbols = (_pages(spark, sf_dir).select("symbol")
               .union(spark.createDataFrame([(UNLANDED_SYMBOL,)], "symbol string")).distinct())
    files = _full_pages(spark, sf_dir).select("symbol", "source_file")
    return resume_point(files, symbols, DEFAULT_START_MS)


@register("next_cursor", f"""
SELECT symbol, page, max(close_time) + 1 AS next_start FROM ({PAGED_SQL}) AS p
GROUP BY symbol, page HAVING max(close_time) + 1 < {NOW_MS}""")
def q_next_cursor(spark, sf_dir):
    from candlewick.sources.pages import next_cursor, parse_kline_pages

    return next_cursor(parse_kline_pages(_pages(spark, sf_dir)), NOW_MS)



@register("empty_pages", f"""
SELECT symbol, page, count(open_time) AS n_rows
FROM (SELECT symbol, page, open_time FROM ({PAGED_SQL}) AS p
      UNION ALL SELECT DISTINCT symbol, -1 AS page, CAST(NULL AS BIGINT) FROM ({PAGED_SQL}) AS p) AS u
GROUP BY symbol, page""")
def q_empty_pages(spark, sf_dir):
    """Candles that each page parses to; every symbol also has an empty page, which parses to none."""
    from candlewick.sources.pages import parse_kline_pages

    pages = _pages(spark, sf_dir)
    empty = pages.select("symbol").distinct().select("symbol", F.lit(-1).alias("page"), F.lit("[]").alias("body"))
    pages = pages.unionByName(empty)
    parsed = parse_kline_pages(pages).groupBy("symbol", "page").agg(F.count(F.lit(1)).alias("n"))
    return pages.select("symbol", "page").join(parsed, ["symbol", "page"], "left") \
        .select("symbol", "page", F.coalesce("n", F.lit(0)).alias("n_rows"))


# Bad numbers: of every eleventh candle of a page the close price, of every thirteenth the trade count.
BAD = {11: ("close_price", "n/a"), 13: ("number_of_trades", "7.5 trades")}


def _pages_with_bad_numbers(spark, sf_dir):
    from candlewick.schema import PAGE_FIELDS
    from candlewick.sources.pages import page_rows

    def planted(row, at):
        fields = [row[i] for i in range(len(PAGE_FIELDS))]
        for every, (column, value) in BAD.items():
            i = PAGE_FIELDS.index(column)
            fields[i] = F.when(at % every == 0, F.lit(value)).otherwise(fields[i])
        return F.array(*fields)

    return _pages(spark, sf_dir).withColumn("body", F.to_json(F.transform(page_rows("body"), planted)))


@register("rejected_values", "\nUNION ALL\n".join(
    f"SELECT symbol, page, pos, '{column}' AS \"column\", '{value}' AS value FROM ({PAGED_SQL}) AS p WHERE pos % {every} = 0"
    for every, (column, value) in BAD.items()))
def q_rejected_values(spark, sf_dir):
    from candlewick.sources.pages import parse_with_rejects, rejected_values

    return rejected_values(parse_with_rejects(_pages_with_bad_numbers(spark, sf_dir)))


@register("good_candles", f"""
SELECT symbol, page, pos, open_time, close_price, number_of_trades FROM ({PAGED_SQL}) AS p
WHERE {" AND ".join(f"pos % {every} <> 0" for every in BAD)}""", ["close_price"])
def q_good_candles(spark, sf_dir):
    from candlewick.sources.pages import good_candles, parse_with_rejects

    return good_candles(parse_with_rejects(_pages_with_bad_numbers(spark, sf_dir))).select(
        "symbol", "page", "pos", "open_time", "close_price", "number_of_trades")

# ---------------------------------------------------------------- ledgered load

# Incremental scenario: the first daily run lands and loads the pages that start
# before CUT_MS (2024-01-16 00:00 UTC); the next run lands every full page.
CUT_MS = 1705363200000

RAW_FROM_PAGES_SQL = f"""
SELECT p.open_time, make_timestamp(p.open_time * 1000) AS open_time_ts,
       p.close_time, make_timestamp(p.close_time * 1000) AS close_time_ts,
       p.open_price, p.high_price, p.low_price, p.close_price, p.volume,
       p.quote_asset_volume, p.number_of_trades, p.taker_buy_base_asset_volume,
       p.taker_buy_quote_asset_volume, f.source_file, p.symbol,
       CAST(make_timestamp(p.open_time * 1000) AS DATE) AS date, f.page_start, p.pos
FROM ({PAGED_SQL}) AS p JOIN ({FULL_PAGES_SQL}) AS f ON p.symbol = f.symbol AND p.page = f.page"""
RAW_COLUMNS = ("open_time, open_time_ts, close_time, close_time_ts, open_price, high_price, "
               "low_price, close_price, volume, quote_asset_volume, number_of_trades, "
               "taker_buy_base_asset_volume, taker_buy_quote_asset_volume, source_file, "
               "symbol, date")


class _Landing:
    """Scratch landing / raw / ledger folders for one query run."""

    def __init__(self, spark, name):
        from candlewick.session import scratch_dir

        self.base = base = scratch_dir(spark, name)
        self.landing, self.raw, self.ledger = (f"{base}/landing", f"{base}/raw",
                                               f"{base}/ledger")

    def land(self, spark, sf_dir, before_ms=None):
        from candlewick.sources.landing import write_landing
        from candlewick.sources.pages import parse_kline_pages

        pages = _full_pages(spark, sf_dir)
        if before_ms is not None:
            pages = pages.where(F.col("page_start") < before_ms)
        write_landing(parse_kline_pages(pages), self.landing)

    def land_resumed(self, spark, sf_dir):
        """A later daily run: each symbol resumes at its latest landed page (S12/S13),
        which is fetched and landed again (T10), and lands every page after it."""
        from candlewick.schema import DEFAULT_START_MS
        from candlewick.sources.landing import resume_point, scan_landing, write_landing
        from candlewick.sources.pages import parse_kline_pages

        pages = _full_pages(spark, sf_dir)
        files = scan_landing(spark, self.landing).select("symbol", "source_file")
        starts = resume_point(files, pages.select("symbol").distinct(), DEFAULT_START_MS)
        fresh = pages.join(starts, "symbol").where(F.col("page_start") >= F.col("start_time"))
        write_landing(parse_kline_pages(fresh.drop("start_time")), self.landing)

    def load(self, spark, **kw):
        from candlewick.plans.load import load_incremental

        return load_incremental(spark, self.landing, self.raw, self.ledger, **kw)

    def visible(self, spark):
        from candlewick.sources.raw import read_raw

        return read_raw(spark, self.raw, self.ledger).drop("load_id")


@register("load_incremental", f"SELECT {RAW_COLUMNS} FROM ({RAW_FROM_PAGES_SQL}) AS r",
          CANDLE_DOUBLES)
def q_load_incremental(spark, sf_dir):
    """Day 1 loads the early pages; day 2 resumes (re-landing each symbol's last
    page) and loads the rest; day 3 finds nothing new: every landed candle is
    visible exactly once."""
    run = _Landing(spark, "load")
    run.land(spark, sf_dir, before_ms=CUT_MS)
    run.load(spark)
    run.land_resumed(spark, sf_dir)
    run.load(spark)
    run.load(spark)
    return run.visible(spark)


@register("landing_job", f"""SELECT {RAW_COLUMNS} FROM ({RAW_FROM_PAGES_SQL}) AS r
WHERE {" AND ".join(f"pos % {every} <> 0" for every in BAD)}""", CANDLE_DOUBLES)
def q_landing_job(spark, sf_dir):
    """Fetched pages with bad numbers through the landing job and the load: full pages are landed without
    the candles that hold a bad value, which the reject table lists."""
    from candlewick.plans.land import land_pages

    run = _Landing(spark, "landjob")
    pages = _pages_with_bad_numbers(spark, sf_dir)
    landed = land_pages(pages, run.landing, PAGE_LIMIT, f"{run.base}/rejects")
    if spark.read.parquet(f"{run.base}/rejects").count() != landed.rejected:
        raise AssertionError("the reject table does not hold every bad value")
    run.load(spark)
    return run.visible(spark)


@register("new_files_only", f"""
SELECT symbol, page_start, source_file FROM ({FULL_PAGES_SQL}) AS f
WHERE page_start >= {CUT_MS}""")
def q_new_files(spark, sf_dir):
    from candlewick.operators.ledger import new_files_only, read_ledger
    from candlewick.sources.landing import scan_landing

    run = _Landing(spark, "newfiles")
    run.land(spark, sf_dir, before_ms=CUT_MS)
    run.load(spark)
    run.land_resumed(spark, sf_dir)
    return new_files_only(scan_landing(spark, run.landing), read_ledger(spark, run.ledger)) \
        .select("symbol", "page_start", "source_file").distinct()


@register("is_loaded", f"""
SELECT source_file, page_start < {CUT_MS} AS is_loaded FROM ({FULL_PAGES_SQL}) AS f""")
def q_is_loaded(spark, sf_dir):
    from candlewick.operators.ledger import loaded_flags, read_ledger
    from candlewick.sources.landing import scan_landing

    run = _Landing(spark, "isloaded")
    run.land(spark, sf_dir, before_ms=CUT_MS)
    run.load(spark)
    run.land_resumed(spark, sf_dir)
    files = scan_landing(spark, run.landing).select("source_file").distinct()
    return loaded_flags(files, read_ledger(spark, run.ledger))


@register("unmark_files", f"""
SELECT source_file, count(*) AS n_rows FROM ({RAW_FROM_PAGES_SQL}) AS r
WHERE page_start < {CUT_MS} GROUP BY source_file""")
def q_unmark(spark, sf_dir):
    """Everything is loaded, then the later pages are withdrawn (as after a failed
    load): their rows disappear from readers without any rewrite."""
    from candlewick.operators.ledger import unmark
    from candlewick.sources.landing import scan_landing

    run = _Landing(spark, "unmark")
    run.land(spark, sf_dir)
    run.load(spark)
    late = scan_landing(spark, run.landing).where(F.col("page_start") >= CUT_MS)
    unmark(spark, late, run.ledger)
    return run.visible(spark).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"))



@register("ledger_events", f"""
SELECT source_file, 'loaded' AS event, TRUE AS stamped, min(date) AS first_day, max(date) AS last_day,
       count(DISTINCT date) AS n_days
FROM ({RAW_FROM_PAGES_SQL}) AS r GROUP BY source_file
UNION ALL
SELECT source_file, 'removed', TRUE, min(date), max(date), count(DISTINCT date)
FROM ({RAW_FROM_PAGES_SQL}) AS r WHERE page_start >= {CUT_MS} GROUP BY source_file""")
def q_ledger_events(spark, sf_dir):
    """What the ledger says after a load in small batches and an un-marking of the later pages: events,
    time stamps within the run, and the days of each file's candles."""
    import datetime as dt

    from candlewick.operators.ledger import read_ledger, unmark
    from candlewick.sources.landing import scan_landing

    run = _Landing(spark, "events")
    before = dt.datetime.now(dt.timezone.utc) - dt.timedelta(minutes=1)
    run.land(spark, sf_dir)
    run.load(spark, max_files_per_load=40)
    unmark(spark, scan_landing(spark, run.landing).where(F.col("page_start") >= CUT_MS), run.ledger)
    days = F.col("days.date")
    return read_ledger(spark, run.ledger).select(
        "source_file", "event", F.col("loaded_at").between(F.lit(before), F.current_timestamp()).alias("stamped"),
        F.array_min(days).alias("first_day"), F.array_max(days).alias("last_day"),
        F.size(days).cast("bigint").alias("n_days"))


@register("ledger_snapshot", f"""
SELECT source_file, page_start < {CUT_MS} AS is_loaded FROM ({FULL_PAGES_SQL}) AS f""")
def q_ledger_snapshot(spark, sf_dir):
    """The flags read from a snapshot: pages loaded in batches, the later ones withdrawn, the ledger
    compacted, one page of each symbol withdrawn and loaded again after that."""
    from candlewick.operators.ledger import compact, is_loaded, ledger_log, loaded_flags, read_ledger, unmark
    from candlewick.sources.landing import scan_landing

    run = _Landing(spark, "snapshot")
    run.land(spark, sf_dir, before_ms=CUT_MS)
    run.load(spark, max_files_per_load=20)
    early = scan_landing(spark, run.landing)
    run.land_resumed(spark, sf_dir)
    run.load(spark, max_files_per_load=20)
    pages = scan_landing(spark, run.landing)
    unmark(spark, pages.where(F.col("page_start") >= CUT_MS), run.ledger)
    compact(spark, run.ledger)
    first = early.groupBy("symbol").agg(F.min_by("source_file", "page_start").alias("source_file"))
    unmark(spark, first, run.ledger)
    one = first.orderBy("symbol").first()["source_file"]
    if is_loaded(read_ledger(spark, run.ledger), one) or not ledger_log(spark, run.ledger).snapshot:
        raise AssertionError("the withdrawn page counts as loaded, or there is no snapshot")
    again = _Landing(spark, "again")
    again.land(spark, sf_dir, before_ms=CUT_MS)
    again.raw, again.ledger = run.raw, run.ledger
    again.load(spark)
    return loaded_flags(pages.select("source_file").distinct(), read_ledger(spark, run.ledger))

# ---------------------------------------------------------------- streaming load (R1), pipeline


@register("stream_load", f"SELECT {RAW_COLUMNS} FROM ({RAW_FROM_PAGES_SQL}) AS r",
          CANDLE_DOUBLES)
def q_stream_load(spark, sf_dir):
    """Early pages, some landed one file each and each symbol's first one as a broken file; then a run
    that lands each symbol's last page again, the pages after it and the broken ones whole; then a run
    with nothing new, beside a folder of other files: every landed candle is visible once, and the
    broken files are in the reject table."""
    from candlewick.sources.landing import write_landing, write_reference_layout
    from candlewick.sources.pages import parse_kline_pages
    from candlewick.streaming.incremental import run_stream_once

    run = _Landing(spark, "stream")
    args = (spark, run.landing, run.raw, run.ledger, f"{run.base}/checkpoint", f"{run.base}/rejected")
    pages = _full_pages(spark, sf_dir)
    early = pages.where(F.col("page_start") < CUT_MS)
    write_landing(parse_kline_pages(early.where("page > 0 AND page % 3 <> 0")), run.landing)
    write_reference_layout(parse_kline_pages(early.where("page > 0 AND page % 3 = 0")), run.landing,
                           ["symbol", "page"]).count()
    broken = _land_broken(spark, pages.where("page = 0"), run.landing)
    run_stream_once(*args)
    rejected = [r[0] for r in spark.read.parquet(f"{run.base}/rejected").select("source_file").collect()]
    if sorted(rejected) != sorted(broken):
        raise AssertionError(f"unexpected rejects: {rejected}")
    klines(spark, sf_dir).select("symbol").distinct().write.parquet(f"{run.landing}/other-files")
    run.land_resumed(spark, sf_dir)
    write_landing(parse_kline_pages(pages.where("page = 0")), run.landing)
    run_stream_once(*args)
    run_stream_once(*args)
    return run.visible(spark)


@register("scan_reference_layout", f"SELECT {RAW_COLUMNS} FROM ({RAW_FROM_PAGES_SQL}) AS r", CANDLE_DOUBLES)
def q_reference_layout(spark, sf_dir):
    """Pages landed one file each at the reference's paths (S7), listed and loaded."""
    from candlewick.sources.landing import write_reference_layout
    from candlewick.sources.pages import parse_kline_pages

    run = _Landing(spark, "reference")
    write_reference_layout(parse_kline_pages(_full_pages(spark, sf_dir)), run.landing, ["symbol", "page"]).count()
    run.load(spark)
    return run.visible(spark)


@register("load_with_bad_file", f"SELECT {RAW_COLUMNS} FROM ({RAW_FROM_PAGES_SQL}) AS r", CANDLE_DOUBLES)
def q_bad_file(spark, sf_dir):
    """Each symbol's first page is landed as a broken file: the load takes the other pages and reports
    these; landed again whole, they are loaded by the next run."""
    from candlewick.sources.landing import write_landing
    from candlewick.sources.pages import parse_kline_pages

    run = _Landing(spark, "badfile")
    pages = _full_pages(spark, sf_dir)
    write_landing(parse_kline_pages(pages.where("page > 0")), run.landing)
    broken = _land_broken(spark, pages.where("page = 0"), run.landing)
    failed = run.load(spark).failed
    if sorted(failed) != sorted(broken):
        raise AssertionError(f"unexpected unreadable pages: {failed}")
    write_landing(parse_kline_pages(pages.where("page = 0")), run.landing)
    run.load(spark)
    return run.visible(spark)


def _land_broken(spark, pages, root: str) -> list[str]:
    """Files that are no Parquet at the pages' own paths (S7); returns their names."""
    from candlewick.storage import create_text, make_folder

    names = [r[0] for r in pages.select("source_file").collect()]  # one page a symbol
    for name in names:
        make_folder(spark, f"{root}/{name}".rsplit("/", 1)[0])
        create_text(spark, f"{root}/{name}", "not a candle page")
    return names


K_PIPE = f"WITH k AS (SELECT * FROM ({RAW_FROM_PAGES_SQL}) AS r)"


def _pipeline(spark, sf_dir):
    from candlewick.plans.pipeline import run_pipeline

    run = _Landing(spark, "pipeline")
    run.land(spark, sf_dir)
    return run_pipeline(spark, run.landing, f"{run.base}/warehouse")


def _table(spark, result, name):
    from candlewick.sinks.models import read_model

    return read_model(spark, result.warehouse, name)


@register("pipeline_market_trend", trend_sql(K_PIPE), TREND_DOUBLES)
def q_pipeline_trend(spark, sf_dir):
    result = _pipeline(spark, sf_dir)
    return _table(spark, result, "market_trend").select(
        "date", "symbol", "sma_7", "sma_30", "ema_7", "ema_30")


@register("pipeline_market_summary", summary_sql(K_PIPE), SUMMARY_DOUBLES)
def q_pipeline_summary(spark, sf_dir):
    result = _pipeline(spark, sf_dir)
    return _table(spark, result, "market_summary").select(
        "date", "symbol", "open_price", "high_price", "low_price", "close_price", "volume",
        "number_of_trades")


def _pipeline_incremental(spark, sf_dir):
    """Two daily runs with incremental refresh: each symbol's first page, then
    the rest (a page ends mid-day, so that day arrives in two loads)."""
    from candlewick.plans.pipeline import run_pipeline
    from candlewick.sources.landing import write_landing
    from candlewick.sources.pages import parse_kline_pages

    run = _Landing(spark, "incremental")
    pages = _full_pages(spark, sf_dir)
    write_landing(parse_kline_pages(pages.where(F.col("page") < 1)), run.landing)
    run_pipeline(spark, run.landing, f"{run.base}/warehouse", incremental=True)
    write_landing(parse_kline_pages(pages.where(F.col("page") >= 1)), run.landing)
    return run_pipeline(spark, run.landing, f"{run.base}/warehouse", incremental=True)


@register("pipeline_incremental_market_trend", trend_sql(K_PIPE), TREND_DOUBLES)
def q_pipeline_incremental_trend(spark, sf_dir):
    result = _pipeline_incremental(spark, sf_dir)
    return _table(spark, result, "market_trend").select(
        "date", "symbol", "sma_7", "sma_30", "ema_7", "ema_30")


@register("pipeline_incremental_market_returns", returns_sql(K_PIPE),
          RETURNS_DOUBLES)
def q_pipeline_incremental_returns(spark, sf_dir):
    result = _pipeline_incremental(spark, sf_dir)
    return _table(spark, result, "market_returns").select(
        "date", "symbol", "daily_return", "cumulative_return")


@register("pipeline_resumed_market_trend", trend_sql(K_PIPE), TREND_DOUBLES)
def q_pipeline_resumed(spark, sf_dir):
    """A run that stopped after the load commit: the pages are loaded, but no model has seen them.
    The next incremental run finds nothing to load and still brings the tables up to date."""
    from candlewick.plans.load import load_incremental
    from candlewick.plans.pipeline import run_pipeline

    run = _Landing(spark, "resumed")
    wh = f"{run.base}/warehouse"
    run.land(spark, sf_dir, before_ms=CUT_MS)
    run_pipeline(spark, run.landing, wh, incremental=True)
    run.land_resumed(spark, sf_dir)
    load_incremental(spark, run.landing, f"{wh}/raw", f"{wh}/ledger")
    result = run_pipeline(spark, run.landing, wh, incremental=True)
    return _table(spark, result, "market_trend").select(
        "date", "symbol", "sma_7", "sma_30", "ema_7", "ema_30")


@register("pipeline_symbols_incremental", summary_sql(f"""WITH k AS (SELECT * FROM ({RAW_FROM_PAGES_SQL}) AS r
  WHERE page_start < {CUT_MS} OR symbol <= 'ERROR')"""), SUMMARY_DOUBLES)
def q_pipeline_symbols(spark, sf_dir):
    """After a run over the early pages, an incremental run for some symbols only: theirs are
    current, and the others' rows stay as they were."""
    from candlewick.plans.pipeline import run_pipeline

    run = _Landing(spark, "symbols")
    run.land(spark, sf_dir, before_ms=CUT_MS)
    run_pipeline(spark, run.landing, f"{run.base}/warehouse", incremental=True)
    run.land_resumed(spark, sf_dir)
    chosen = [r[0] for r in klines(spark, sf_dir).where("symbol <= 'ERROR'").select("symbol").distinct().collect()]
    result = run_pipeline(spark, run.landing, f"{run.base}/warehouse", symbols=chosen, incremental=True)
    return _table(spark, result, "market_summary").select(
        "date", "symbol", "open_price", "high_price", "low_price", "close_price", "volume",
        "number_of_trades")


@register("pipeline_unmark_market_summary", summary_sql(f"WITH k AS (SELECT * FROM ({RAW_FROM_PAGES_SQL}) AS r WHERE page_start < {CUT_MS})"), SUMMARY_DOUBLES)
def q_pipeline_unmark(spark, sf_dir):
    """All pages are loaded and modelled, then the later ones are withdrawn (and no longer landed):
    the next incremental run takes their rows, and whole days, out of the models."""
    from candlewick.operators.ledger import unmark
    from candlewick.plans.pipeline import run_pipeline
    from candlewick.sources.landing import scan_landing

    run, early = _Landing(spark, "unmarked"), _Landing(spark, "early")
    run.land(spark, sf_dir)
    early.land(spark, sf_dir, before_ms=CUT_MS)
    wh = f"{run.base}/warehouse"
    run_pipeline(spark, run.landing, wh, incremental=True)
    unmark(spark, scan_landing(spark, run.landing).where(F.col("page_start") >= CUT_MS), f"{wh}/ledger")
    result = run_pipeline(spark, early.landing, wh, incremental=True)
    return _table(spark, result, "market_summary").select(
        "date", "symbol", "open_price", "high_price", "low_price", "close_price", "volume",
        "number_of_trades")


@register("pipeline_interrupted_symbols", summary_sql(K_PIPE), SUMMARY_DOUBLES)
def q_pipeline_interrupted(spark, sf_dir):
    """Early pages are modelled; a refresh of some symbols stops after it wrote its staging rows, and
    another one before its commit; then all symbols are refreshed: no symbol has lost a row."""
    from candlewick.plans.pipeline import StoppedForTest, run_pipeline

    run = _Landing(spark, "interrupted")
    wh = f"{run.base}/warehouse"
    run.land(spark, sf_dir, before_ms=CUT_MS)
    run_pipeline(spark, run.landing, wh, incremental=True)
    run.land_resumed(spark, sf_dir)
    chosen = [r[0] for r in klines(spark, sf_dir).where("symbol <= 'ERROR'").select("symbol").distinct().collect()]
    for step in ("market_trend", "commit"):
        with suppress(StoppedForTest):  # it does not stop where these symbols have no later page
            run_pipeline(spark, run.landing, wh, symbols=chosen, incremental=True, stop_before=step)
    run_pipeline(spark, run.landing, wh, symbols=chosen, incremental=True)
    result = run_pipeline(spark, run.landing, wh, incremental=True)
    return _table(spark, result, "market_summary").select(
        "date", "symbol", "open_price", "high_price", "low_price", "close_price", "volume", "number_of_trades")


@register("pipeline_shrunk_page", returns_sql(f"""WITH k AS (SELECT r.* FROM ({RAW_FROM_PAGES_SQL}) AS r
  JOIN (SELECT symbol, max(page_start) AS newest FROM ({FULL_PAGES_SQL}) AS f GROUP BY symbol) AS n
  ON r.symbol = n.symbol AND r.page_start < n.newest)"""), RETURNS_DOUBLES)
def q_pipeline_shrunk(spark, sf_dir):
    """After all pages are modelled, each symbol's newest page comes back with a candle less. It is
    not kept: the landing withdraws it, the next run its raw rows, and the models follow."""
    from candlewick.plans.pipeline import run_pipeline
    from candlewick.sources.landing import remove_short_pages
    from candlewick.sources.pages import page_rows

    run = _Landing(spark, "shrunk")
    run.land(spark, sf_dir)
    run_pipeline(spark, run.landing, f"{run.base}/warehouse", incremental=True)
    pages = _full_pages(spark, sf_dir)
    newest = pages.groupBy("symbol").agg(F.max("page").alias("page"))
    shrunk = pages.join(newest, ["symbol", "page"]).withColumn(
        "body", F.to_json(F.slice(page_rows("body"), 1, PAGE_LIMIT - 1)))
    if remove_short_pages(spark, shrunk, run.landing, PAGE_LIMIT) != newest.count():
        raise AssertionError("not every shrunk page was withdrawn")
    result = run_pipeline(spark, run.landing, f"{run.base}/warehouse", incremental=True)
    return _table(spark, result, "market_returns").select("date", "symbol", "daily_return", "cumulative_return")
