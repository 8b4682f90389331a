"""The command line runs the daily job, re-checks it, and finds nothing new after."""

import json

import pytest
from helpers import rounded

from candlewick.__main__ import main
from candlewick.plans import registry as R
from candlewick.sinks.models import read_model
from candlewick.sources.landing import write_landing
from candlewick.sources.pages import parse_kline_pages


def test_run_check_load(spark, tmp, capsys):
    landing, wh = f"{tmp}/landing", f"{tmp}/wh"
    write_landing(parse_kline_pages(R._full_pages(spark, "/root/testdata/sf0.001")), landing)
    assert main(["run", "--landing", landing, "--warehouse", wh]) == 0
    run = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert run["files"] > 0 and run["checks"] == 36
    assert main(["check", "--warehouse", wh]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"checks": 36, "grain": 3}
    assert main(["load", "--landing", landing, "--warehouse", wh]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["files"] == 0
    summary = read_model(spark, wh, "market_summary")
    assert summary.count() == summary.select("date", "symbol").distinct().count() > 0


def test_stream_twice_loads_once(spark, tmp, capsys):
    landing, wh = f"{tmp}/landing", f"{tmp}/wh"
    pages = R._full_pages(spark, "/root/testdata/sf0.001")
    write_landing(parse_kline_pages(pages), landing)
    assert main(["stream", "--landing", landing, "--warehouse", wh]) == 0
    assert main(["stream", "--landing", landing, "--warehouse", wh]) == 0
    table = json.loads(capsys.readouterr().out.strip().splitlines()[-1])["table"]
    from candlewick.sources.raw import read_raw

    assert read_raw(spark, table, f"{wh}/ledger").count() == pages.count() * R.PAGE_LIMIT


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_incremental_pipeline_equals_full_rebuild(spark, tmp, sf):
    """Two daily runs with incremental refresh give the tables of one full run.
    The first run lands each symbol's first page, the second the rest; a page
    ends mid-day, so that day is split across the two loads. At sf0.001 a
    symbol-day holds ~7 candles, so the second run's 29-candle context spans
    several earlier days."""
    from pyspark.sql import functions as F

    from candlewick.plans.pipeline import MODELS, run_pipeline

    pages = R._full_pages(spark, f"/root/testdata/{sf}")
    inc_landing, full_landing = f"{tmp}/inc_landing", f"{tmp}/full_landing"
    write_landing(parse_kline_pages(pages.where(F.col("page") < 1)), inc_landing)
    first = run_pipeline(spark, inc_landing, f"{tmp}/inc", incremental=True)
    write_landing(parse_kline_pages(pages.where(F.col("page") >= 1)), inc_landing)
    second = run_pipeline(spark, inc_landing, f"{tmp}/inc", incremental=True)
    assert first.load.files > 0 and second.load.files > 0
    assert run_pipeline(spark, inc_landing, f"{tmp}/inc", incremental=True).load.files == 0
    write_landing(parse_kline_pages(pages), full_landing)
    run_pipeline(spark, full_landing, f"{tmp}/full")
    for name in ["stg_klines", *MODELS, "series_state"]:
        a = read_model(spark, f"{tmp}/inc", name)
        b = read_model(spark, f"{tmp}/full", name).select(*a.columns)
        assert rounded(a.collect(), 9) == rounded(b.collect(), 9), name


def test_incremental_with_a_new_symbol(spark, tmp):
    """A symbol first seen in a later run has no state and no context rows."""
    from pyspark.sql import functions as F

    from candlewick.plans.pipeline import MODELS, run_pipeline

    pages = R._full_pages(spark, "/root/testdata/sf0.001")
    newcomer = pages.select("symbol").distinct().orderBy("symbol").first()[0]
    early = (F.col("symbol") != newcomer) & (F.col("page") < 1)
    write_landing(parse_kline_pages(pages.where(early)), f"{tmp}/l")
    run_pipeline(spark, f"{tmp}/l", f"{tmp}/inc", incremental=True)
    write_landing(parse_kline_pages(pages.where(~early)), f"{tmp}/l")
    run_pipeline(spark, f"{tmp}/l", f"{tmp}/inc", incremental=True)
    write_landing(parse_kline_pages(pages), f"{tmp}/all")
    run_pipeline(spark, f"{tmp}/all", f"{tmp}/full")
    for name in MODELS:
        a = read_model(spark, f"{tmp}/inc", name)
        b = read_model(spark, f"{tmp}/full", name).select(*a.columns)
        assert rounded(a.collect(), 9) == rounded(b.collect(), 9), name


def _tables(spark, wh):
    from candlewick.plans.pipeline import TABLES

    return {t: rounded(read_model(spark, wh, t).collect(), 9) for t in TABLES}


def test_a_run_stopped_at_any_step_leaves_the_old_tables(spark, tmp):
    """Stopped before each table and before the commit: all tables are those of the run before, and the
    next run brings them to where a full run does, whichever symbols the stopped one was for."""
    from pyspark.sql import functions as F

    from candlewick.plans.pipeline import TABLES, StoppedForTest, run_pipeline

    pages = R._full_pages(spark, "/root/testdata/sf0.001")
    some = [pages.select("symbol").distinct().orderBy("symbol").first()[0]]
    write_landing(parse_kline_pages(pages.where(F.col("page") < 1)), f"{tmp}/l")
    run_pipeline(spark, f"{tmp}/l", f"{tmp}/wh", incremental=True)
    old = _tables(spark, f"{tmp}/wh")
    write_landing(parse_kline_pages(pages.where(F.col("page") >= 1)), f"{tmp}/l")
    for i, step in enumerate([*TABLES, "commit"]):
        with pytest.raises(StoppedForTest):
            run_pipeline(spark, f"{tmp}/l", f"{tmp}/wh", incremental=True, stop_before=step,
                         symbols=None if i % 2 else [r[0] for r in pages.select("symbol").distinct().collect()])
        assert _tables(spark, f"{tmp}/wh") == old, step
    run_pipeline(spark, f"{tmp}/l", f"{tmp}/wh", symbols=some, incremental=True)
    run_pipeline(spark, f"{tmp}/l", f"{tmp}/wh", incremental=True)
    run_pipeline(spark, f"{tmp}/l", f"{tmp}/full")
    new, full = _tables(spark, f"{tmp}/wh"), _tables(spark, f"{tmp}/full")
    assert {t for t in TABLES if new[t] != full[t]} == set()


@pytest.mark.parametrize("kept_days", [2, 0])
def test_withdrawing_whole_days_takes_them_out(spark, tmp, kept_days):
    """Pages that end with the day are withdrawn: no candle of the touched days is left, so the refresh
    writes no row of any table, and the tables keep the other days (or none)."""
    from pyspark.sql import functions as F

    from candlewick.operators.ledger import unmark
    from candlewick.plans.pipeline import TABLES, run_pipeline
    from candlewick.sources.landing import scan_landing
    from candlewick.sources.pages import pages_from_candles, with_landing_path

    day, first = 86_400_000, 1_704_067_200_000  # 2024-01-01
    rows = [(first + d * day + m * 60_000, 1.0 + d, 2.0 + d, 0.5, 1.5 + m, 3.0, first + d * day + m * 60_000 + 59_999,
             4.0, 2, 1.5, 2.0, s) for s in ("AAA", "BBB") for d in range(4) for m in range(6)]
    candles = spark.createDataFrame(rows, (
        "open_time long, open_price double, high_price double, low_price double, close_price double, volume double, "
        "close_time long, quote_asset_volume double, number_of_trades long, taker_buy_base_asset_volume double, "
        "taker_buy_quote_asset_volume double, symbol string"))
    pages = with_landing_path(pages_from_candles(candles, 3))
    late = F.col("page_start") >= first + kept_days * day
    write_landing(parse_kline_pages(pages), f"{tmp}/l")
    run_pipeline(spark, f"{tmp}/l", f"{tmp}/wh", incremental=True)
    unmark(spark, scan_landing(spark, f"{tmp}/l").where(late), f"{tmp}/wh/ledger")
    write_landing(parse_kline_pages(pages.where(~late)), f"{tmp}/early")
    result = run_pipeline(spark, f"{tmp}/early", f"{tmp}/wh", incremental=True)
    assert result.load.files == 0 and set(result.tables) == set(TABLES)
    left = _tables(spark, f"{tmp}/wh")
    assert {t: len(x) for t, x in left.items()} == {t: kept_days * 2 * (6 if t in (
        "stg_klines", "market_returns", "market_trend") else 1) for t in TABLES}
    if kept_days:
        run_pipeline(spark, f"{tmp}/early", f"{tmp}/full")
        assert left == _tables(spark, f"{tmp}/full")


def test_a_failed_check_keeps_the_old_tables(spark, tmp):
    from pyspark.sql import functions as F

    from candlewick.operators.quality import QualityError
    from candlewick.plans.pipeline import run_pipeline

    pages = R._full_pages(spark, "/root/testdata/sf0.001")
    good = parse_kline_pages(pages.where("page = 0"))
    write_landing(good, f"{tmp}/l")
    run_pipeline(spark, f"{tmp}/l", f"{tmp}/wh", incremental=True)
    old = _tables(spark, f"{tmp}/wh")
    bad = parse_kline_pages(pages.where("page = 1")).withColumn("close_time", F.lit(None).cast("long"))
    write_landing(bad, f"{tmp}/l")
    with pytest.raises(QualityError, match="stg_klines.*close_time_ts"):
        run_pipeline(spark, f"{tmp}/l", f"{tmp}/wh", incremental=True)
    assert _tables(spark, f"{tmp}/wh") == old


def test_refresh_reads_only_touched_days(spark, tmp):
    """The staged rows of a refresh prune the stored date; which days, the ledger says without raw rows."""
    from candlewick.operators.ledger import events_after
    from candlewick.plans import pipeline as P
    from candlewick.sinks.models import Warehouse

    pages = R._full_pages(spark, "/root/testdata/sf0.001")
    write_landing(parse_kline_pages(pages.where("page = 0")), f"{tmp}/l")
    P.run_pipeline(spark, f"{tmp}/l", f"{tmp}/wh", incremental=True)
    write_landing(parse_kline_pages(pages.where("page > 0")), f"{tmp}/l")
    old = Warehouse(spark, f"{tmp}/wh").current()
    loaded = P.load_incremental(spark, f"{tmp}/l", f"{tmp}/wh/raw", f"{tmp}/wh/ledger")
    events, last = P.pending_events(spark, f"{tmp}/wh/ledger", old.consumed)
    assert events.count() == loaded.files and last == old.consumed[""] + 1
    days = P.touched_days(spark, "/no/raw/table", events)
    raw = spark.read.parquet(f"{tmp}/wh/raw").where(f"load_id = '{loaded.load_id}'")
    assert days == sorted(r[0] for r in raw.select("date").distinct().collect())
    build = P._Build(spark, Warehouse(spark, f"{tmp}/wh"), old, f"{tmp}/wh/raw", f"{tmp}/wh/ledger", days, None,
                     "sliced", 1, lambda name: None, {})
    plan = build.staged()._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "date#" in filters and "load_id#" in filters
    assert events_after(spark, f"{tmp}/wh/ledger", last)[0].count() == 0


def test_refresh_reads_few_days_before_the_first(spark, tmp):
    """The look-back of M4/M5 opens the days that hold it, not the history."""
    from candlewick.operators import sliced
    from candlewick.plans.pipeline import run_pipeline
    from candlewick.sinks.models import Warehouse

    pages = R._full_pages(spark, "/root/testdata/sf0.01")
    write_landing(parse_kline_pages(pages), f"{tmp}/l")
    run_pipeline(spark, f"{tmp}/l", f"{tmp}/wh")
    house = Warehouse(spark, f"{tmp}/wh")
    days = sorted(house.current().days["stg_klines"])
    start = days[-2]
    candles, base = sliced.refresh_inputs(house.read("series_state"), house.read("stg_klines"), start)
    plan = candles._jdf.queryExecution().executedPlan().toString()
    scans = [line.split("PartitionFilters: [")[1].split("], PushedFilters")[0] for line in plan.split("\n")
             if "FileScan" in line and "close_price" in line]
    named = {d for f in scans for d in days if d in f}  # dates that the filters list
    assert len(scans) == 2 and all("date#" in f for f in scans) and named <= set(days[-5:])
    symbols = base.count()
    before = candles.where(f"open_time_ts < TIMESTAMP'{start} 00:00:00'").count()
    assert before == 29 * symbols


def test_old_versions_are_deleted(spark, tmp):
    import os

    from candlewick.sinks.models import KEEP, Warehouse

    house = Warehouse(spark, f"{tmp}/wh")
    df = lambda n: spark.createDataFrame([(n, None), (n, "2024-01-01")], "n int, d string").selectExpr("n", "CAST(d AS DATE) AS date")
    snapshot = house.current()
    for n in range(5):
        days = house.write("t", df(n))
        house.write("t", df(99))  # of a run that never committed
        snapshot = house.commit(snapshot, {"t": days}, {"t": df(n).schema.json()}, {})
    assert sorted(r["n"] for r in house.read("t").collect()) == [4, 4]
    assert len([n for n in os.listdir(f"{tmp}/wh/t") if n.startswith("v=")]) == KEEP
    assert len(house.log.numbers()) == KEEP
    with pytest.raises(FileExistsError):
        house.commit(type(snapshot)(snapshot.number - 1), {}, {}, {})  # a slower writer


def test_land_job(spark, tmp, capsys):
    """Full pages are landed, short ones not; a landed page that comes back short is withdrawn; malformed
    numbers stop the job, or go to a table."""
    from candlewick.sources.landing import read_landed, scan_landing

    limit, landing = R.PAGE_LIMIT, f"{tmp}/landing"
    pages = R._pages(spark, "/root/testdata/sf0.001").select("symbol", "body")
    full = R._full_pages(spark, "/root/testdata/sf0.001")
    pages.write.json(f"{tmp}/pages")
    assert main(["land", "--pages", f"{tmp}/pages", "--landing", landing, "--limit", str(limit)]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out == {"candles": full.count() * limit, "rejected": 0, "withdrawn": 0}
    assert scan_landing(spark, landing).count() == full.count() < pages.count()
    first = json.loads(full.orderBy("symbol", "page").first()["body"])
    symbol = full.orderBy("symbol", "page").first()["symbol"]
    one = lambda rows: spark.createDataFrame([(symbol, json.dumps(rows))], "symbol string, body string")
    one(first[:-1]).write.parquet(f"{tmp}/short.parquet")
    assert main(["land", "--pages", f"{tmp}/short.parquet", "--landing", landing, "--limit", str(limit)]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"candles": 0, "rejected": 0, "withdrawn": 1}
    assert scan_landing(spark, landing).count() == full.count() - 1
    first[3][4] = "n/a"
    one(first).write.parquet(f"{tmp}/bad.parquet")
    args = ["land", "--pages", f"{tmp}/bad.parquet", "--landing", landing, "--limit", str(limit)]
    with pytest.raises(ValueError, match="close_price='n/a'"):
        main(args)
    assert scan_landing(spark, landing).count() == full.count() - 1
    assert main([*args, "--rejects", f"{tmp}/rejects"]) == 0
    bad = spark.read.parquet(f"{tmp}/rejects").collect()
    assert [(r["symbol"], r["pos"], r["column"], r["value"]) for r in bad] == [(symbol, 3, "close_price", "n/a")]
    assert read_landed(spark, scan_landing(spark, landing)).count() == full.count() * limit - 1


def test_a_page_is_parsed_once(spark):
    from candlewick.sources.pages import parse_kline_pages as parse

    plan = parse(R._pages(spark, "/root/testdata/sf0.001"), limit=R.PAGE_LIMIT)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1
