"""Ledgered load (S8-S26), crash safety (§4b) and the streaming load."""

import os

import pytest
from pyspark.sql import functions as F

from candlewick.operators.ledger import is_loaded, loaded_files, read_ledger, unmark
from candlewick.plans import registry as R
from candlewick.plans.load import CrashForTest, load_incremental
from candlewick.sources.landing import read_landed, scan_landing, write_landing
from candlewick.sources.pages import parse_kline_pages
from candlewick.sources.raw import read_raw
from candlewick.streaming.incremental import run_stream_once

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pages(spark):
    return R._full_pages(spark, SF).cache()


def _paths(tmp):
    return f"{tmp}/landing", f"{tmp}/raw", f"{tmp}/ledger"


def _land(pages, root, cond=None):
    write_landing(parse_kline_pages(pages if cond is None else pages.where(cond)), root)


def test_reload_loads_nothing_then_only_the_new_file(spark, pages, tmp):
    landing, raw, ledger = _paths(tmp)
    first = pages.orderBy("symbol", "page").limit(3).select("symbol", "page")
    rest = pages.join(first, ["symbol", "page"], "left_anti")
    _land(pages.join(first, ["symbol", "page"], "left_semi"), landing)
    assert load_incremental(spark, landing, raw, ledger).files == 3
    assert load_incremental(spark, landing, raw, ledger).files == 0
    one_more = rest.orderBy("symbol", "page").limit(1)
    _land(one_more, landing)
    assert load_incremental(spark, landing, raw, ledger).files == 1
    visible = read_raw(spark, raw, ledger)
    assert visible.count() == 4 * R.PAGE_LIMIT
    assert visible.groupBy("symbol", "open_time").count().where("count > 1").count() == 0
    src = one_more.select("source_file").first()[0]
    assert is_loaded(read_ledger(spark, ledger), src)
    assert not is_loaded(read_ledger(spark, ledger), "binance_klines/NOPE/x.parquet")


def test_backfill_commits_in_bounded_batches(spark, pages, tmp):
    landing, raw, ledger = _paths(tmp)
    _land(pages, landing)
    total = pages.count()
    result = load_incremental(spark, landing, raw, ledger, max_files_per_load=3)
    assert result.files == total and len(result.load_ids) == -(-total // 3)
    assert read_raw(spark, raw, ledger).count() == total * R.PAGE_LIMIT
    assert load_incremental(spark, landing, raw, ledger, max_files_per_load=3).files == 0


def test_crash_between_append_and_commit(spark, pages, tmp):
    landing, raw, ledger = _paths(tmp)
    early = pages.orderBy("symbol", "page").limit(2)
    _land(early, landing)
    with pytest.raises(CrashForTest):
        load_incremental(spark, landing, raw, ledger, fail_before_commit=True)
    assert read_raw(spark, raw, ledger).count() == 0  # orphan rows are invisible
    _land(pages.orderBy("symbol", "page").offset(2).limit(1), landing)  # a file arrives
    assert load_incremental(spark, landing, raw, ledger).files == 3
    visible = read_raw(spark, raw, ledger)
    assert visible.count() == 3 * R.PAGE_LIMIT
    assert visible.groupBy("symbol", "open_time").count().where("count > 1").count() == 0
    on_disk = spark.read.parquet(raw).count()
    assert on_disk == 5 * R.PAGE_LIMIT  # two orphan pages stay on disk, unseen


def test_unmark_hides_rows_and_next_load_reloads(spark, pages, tmp):
    landing, raw, ledger = _paths(tmp)
    _land(pages, landing)
    total = load_incremental(spark, landing, raw, ledger).files
    victim = scan_landing(spark, landing).select("source_file").orderBy("source_file").limit(1)
    unmark(spark, victim, ledger)
    assert loaded_files(read_ledger(spark, ledger)).count() == total - 1
    assert read_raw(spark, raw, ledger).count() == (total - 1) * R.PAGE_LIMIT
    assert load_incremental(spark, landing, raw, ledger).files == 1
    assert read_raw(spark, raw, ledger).count() == total * R.PAGE_LIMIT


def test_relanding_a_page_replaces_only_that_page(spark, pages, tmp):
    landing = f"{tmp}/landing"
    _land(pages, landing)
    before = scan_landing(spark, landing).count()
    _land(pages.orderBy("symbol", "page").limit(1), landing)
    files = scan_landing(spark, landing)
    assert files.count() == before
    assert read_landed(spark, files).count() == pages.count() * R.PAGE_LIMIT


def test_a_landing_run_is_one_log_file(spark, pages, tmp):
    """Many pages lie in few files, and a run whose log file is missing is not there."""
    landing = f"{tmp}/landing"
    _land(pages.repartition(2), landing)
    logs = [n for n in os.listdir(f"{landing}/_landed/log") if n.endswith(".parquet") and n[0] != "."]
    data = [n for _, _, names in os.walk(f"{landing}/_landed/data") for n in names if n.endswith(".parquet")]
    assert len(logs) == 1 and len(data) <= 2 < pages.count() and os.listdir(landing) == ["_landed"]
    _land(pages.limit(1), landing)
    newest = sorted(n for n in os.listdir(f"{landing}/_landed/log") if n[0] != ".")[-1]
    os.remove(f"{landing}/_landed/log/{newest}")
    assert scan_landing(spark, landing).count() == pages.count()
    for f in scan_landing(spark, landing).inputFiles():
        assert "/_landed/log/" in f  # no data folder is listed


def test_older_layouts_are_read(spark, pages, tmp):
    """Pages landed one file each, in either layout, beside the log; a page in both is the log's."""
    from candlewick.sources.landing import page_key, write_reference_layout

    landing, raw, ledger = _paths(tmp)
    parsed = parse_kline_pages(pages)
    hive = parsed.where("page = 0").withColumn("page", page_key("page_start"))
    hive.drop("pos", "page_start", "source_file").write.partitionBy("symbol", "page").parquet(landing)
    write_reference_layout(parsed.where("page > 0"), landing, ["symbol", "page"]).count()
    _land(pages.orderBy("symbol", "page").limit(1), landing)
    assert scan_landing(spark, landing).count() == pages.count()
    assert load_incremental(spark, landing, raw, ledger).files == pages.count()
    rows = read_raw(spark, raw, ledger)
    assert rows.count() == rows.select("symbol", "open_time").distinct().count() == pages.count() * R.PAGE_LIMIT


def test_junk_files_are_not_listed(spark, pages, tmp):
    landing = f"{tmp}/landing"
    _land(pages.limit(1), landing)
    os.makedirs(f"{landing}/symbol=lower/page=2024-01-01-0000", exist_ok=True)
    spark.range(1).write.parquet(f"{landing}/junk")
    spark.range(1).write.mode("overwrite").parquet(
        f"{landing}/symbol=lower/page=2024-01-01-0000")
    files = scan_landing(spark, landing)
    assert files.select("symbol").distinct().count() == 1
    assert files.where(F.col("symbol") == "lower").count() == 0


def _break(path):
    with open(path, "wb") as f:
        f.write(b"PAR1 no candle page PAR1")


def test_broken_data_file_costs_its_pages_only(spark, pages, tmp):
    """A broken data file of several pages: found in one pass, the other pages are loaded."""
    landing, raw, ledger = _paths(tmp)
    _land(pages.repartition(4, "symbol", "page"), landing)
    files = [r["path"] for r in scan_landing(spark, landing).select("path").distinct().collect()]
    victim = "/" + files[0].removeprefix("file:").lstrip("/")
    lost = scan_landing(spark, landing).where(F.col("path") == files[0]).count()
    crc = f"{os.path.dirname(victim)}/.{os.path.basename(victim)}.crc"
    os.remove(crc)
    _break(victim)
    result = load_incremental(spark, landing, raw, ledger)
    assert len(result.failed) == lost and result.files == pages.count() - lost
    assert read_raw(spark, raw, ledger).count() == result.files * R.PAGE_LIMIT
    assert spark.read.parquet(raw).count() == result.files * R.PAGE_LIMIT  # the failed attempt left nothing
    _land(pages, landing)
    assert load_incremental(spark, landing, raw, ledger).files == lost


def test_an_error_that_no_file_explains_is_raised(spark, pages, tmp):
    from candlewick.plans.load import append_pages

    landing, raw, _ = _paths(tmp)
    _land(pages.limit(1), landing)

    def fail(rows, path):
        raise RuntimeError("disk full")

    with pytest.raises(RuntimeError, match="disk full"):
        append_pages(spark, scan_landing(spark, landing), raw, "x", append=fail)


def test_ledger_snapshot_equals_its_events(spark, pages, tmp, monkeypatch):
    """Any number of commits between snapshots gives the same state, and later commits are read on top."""
    from candlewick.operators import ledger as L

    names = [f"binance_klines/S{i}/x" for i in range(12)]
    files = lambda part: spark.createDataFrame([(n,) for n in part], "source_file string")
    states = []
    for every in (1, 3, 1000):
        monkeypatch.setattr(L, "COMPACT_EVERY", every)
        path = f"{tmp}/ledger{every}"
        L.mark_loaded(files(names[:6]), path, "a")
        L.mark_loaded(files(names[6:]), path, "b")
        L.unmark(spark, files(names[4:8]), path)
        L.mark_loaded(files(names[4:5]), path, "c")
        L.replace_loaded(spark, files(names[:2]), path, "d")
        assert L.replace_loaded(spark, files(names[:2]), path, "d") == 5  # nothing to do: no commit
        log = L.ledger_log(spark, path)
        assert log.last == 5 and log.load_ids() == ["a", "b", "c", "d"]
        assert len(log.parts()) == {1: 1, 3: 3, 1000: 5}[every]
        events = read_ledger(spark, path)
        gone = sorted(map(tuple, L.tombstones(spark, log).collect()))
        states.append((sorted(map(tuple, L.active_files(events).collect())), gone))
        if every == 1:  # what a tombstone cancelled is gone from the state
            assert events.where("event = 'loaded'").count() == len(states[0][0])
    assert states[0] == states[1] == states[2] and len(states[0][0]) == 9


def test_reading_raw_starts_no_job_and_prunes_days(spark, pages, tmp):
    landing, raw, ledger = _paths(tmp)
    _land(pages, landing)
    load_incremental(spark, landing, raw, ledger)
    unmark(spark, scan_landing(spark, landing).limit(1), ledger)
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    one_day = read_raw(spark, raw, ledger).where("date = DATE'2024-01-03'")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert len(tracker.getJobIdsForGroup(None)) == before
    scan = [line for line in plan.split("\n") if "FileScan" in line and "load_id" in line][0]
    filters = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "date#" in filters and "load_id#" in filters


def test_streaming_three_runs(spark, pages, tmp):
    landing, raw, ledger = _paths(tmp)
    args = (spark, landing, raw, ledger, f"{tmp}/ckpt")
    first = pages.orderBy("symbol", "page").limit(3).select("symbol", "page")
    _land(pages.join(first, ["symbol", "page"], "left_semi"), landing)
    run_stream_once(*args)
    assert read_raw(spark, raw, ledger).count() == 3 * R.PAGE_LIMIT
    run_stream_once(*args)
    assert read_raw(spark, raw, ledger).count() == 3 * R.PAGE_LIMIT
    _land(pages.join(first, ["symbol", "page"], "left_anti").orderBy("symbol", "page")
          .limit(1), landing)
    run_stream_once(*args)
    assert read_raw(spark, raw, ledger).count() == 4 * R.PAGE_LIMIT


def test_streamed_page_landed_again_replaces_itself(spark, pages, tmp):
    landing, raw, ledger = _paths(tmp)
    args = (spark, landing, raw, ledger, f"{tmp}/ckpt")
    two = pages.orderBy("symbol", "page").limit(2)
    _land(two, landing)
    run_stream_once(*args)
    spark.range(1).write.parquet(f"{landing}/stray")
    _land(two.limit(1), landing)
    run_stream_once(*args)
    visible = read_raw(spark, raw, ledger)
    assert visible.count() == 2 * R.PAGE_LIMIT
    assert visible.groupBy("symbol", "open_time").count().where("count > 1").count() == 0
    assert load_incremental(spark, landing, raw, ledger).files == 0  # the daily load sees them as loaded


def test_stream_with_a_new_checkpoint_keeps_landed_again_pages(spark, pages, tmp):
    landing, raw, ledger = _paths(tmp)
    two = pages.orderBy("symbol", "page").limit(2)
    _land(two, landing)
    run_stream_once(spark, landing, raw, ledger, f"{tmp}/ckpt")
    _land(two.limit(1), landing)
    run_stream_once(spark, landing, raw, ledger, f"{tmp}/ckpt")
    for _ in range(2):  # the second run finds nothing new
        run_stream_once(spark, landing, raw, ledger, f"{tmp}/other")
        visible = read_raw(spark, raw, ledger)
        assert visible.count() == 2 * R.PAGE_LIMIT
        assert visible.groupBy("symbol", "open_time").count().where("count > 1").count() == 0
    loads = {r["load_id"] for r in read_ledger(spark, ledger).select("load_id").distinct().collect()}
    assert len(loads) == 3


def test_short_page_is_taken_back(spark, pages, tmp):
    from candlewick.sources.landing import remove_short_pages

    landing, _, _ = _paths(tmp)
    one = pages.orderBy("symbol", "page").limit(1)
    _land(one, landing)
    assert remove_short_pages(spark, one, landing, R.PAGE_LIMIT) == 0
    assert remove_short_pages(spark, one, landing, R.PAGE_LIMIT + 1) == 1
    assert scan_landing(spark, landing).count() == 0
    assert remove_short_pages(spark, one, landing, R.PAGE_LIMIT + 1) == 0  # it is gone already


def test_short_page_leaves_raw_with_the_next_load(spark, pages, tmp):
    from candlewick.sources.landing import remove_short_pages, write_reference_layout

    landing, raw, ledger = _paths(tmp)
    write_reference_layout(parse_kline_pages(pages.where("page = 0")), landing, ["symbol", "page"]).count()
    _land(pages, landing, "page > 0")
    total = load_incremental(spark, landing, raw, ledger).files
    logged = pages.where("page > 0").orderBy("symbol", "page").limit(1)
    single = pages.where("page = 0").orderBy("symbol").limit(1)
    assert remove_short_pages(spark, logged.unionByName(single), landing, R.PAGE_LIMIT + 1) == 2
    assert scan_landing(spark, landing).count() == total - 2
    assert load_incremental(spark, landing, raw, ledger).files == 0
    assert read_raw(spark, raw, ledger).count() == (total - 2) * R.PAGE_LIMIT
    _land(logged, landing)  # whole again
    assert load_incremental(spark, landing, raw, ledger).files == 1
    assert read_raw(spark, raw, ledger).count() == (total - 1) * R.PAGE_LIMIT


def test_stream_archives_one_file_pages_and_withdraws_short_ones(spark, pages, tmp):
    import time

    from candlewick.sources.landing import remove_short_pages, write_reference_layout

    landing, raw, ledger = _paths(tmp)
    write_reference_layout(parse_kline_pages(pages.where("page = 0")), landing, ["symbol", "page"]).count()
    _land(pages, landing, "page > 0")
    args = (spark, landing, raw, ledger, f"{tmp}/ckpt", None, f"{tmp}/archive")
    total = pages.count() * R.PAGE_LIMIT
    run_stream_once(*args)
    assert read_raw(spark, raw, ledger).count() == total
    one = pages.where("page > 0").orderBy("symbol", "page").limit(1)
    assert remove_short_pages(spark, one, landing, R.PAGE_LIMIT + 1) == 1
    for _ in range(2):  # the second run finds nothing new
        run_stream_once(*args)
        assert read_raw(spark, raw, ledger).count() == total - R.PAGE_LIMIT
    moved = lambda: [n for _, _, names in os.walk(f"{tmp}/archive") for n in names if n.endswith(".parquet")]
    for _ in range(50):  # the source moves files in the background
        if moved():
            break
        time.sleep(0.1)
    assert moved()


def test_a_batch_costs_the_same_however_many_came_before(spark, pages, tmp, monkeypatch):
    """The days of a load are read from its own folder, a commit reads no earlier entry, and a batch
    reads the data files of its own pages."""
    from candlewick.operators import ledger as L
    from candlewick.plans import load as P
    from candlewick.sources.raw import days_of_files, load_folder

    landing, raw, ledger = _paths(tmp)
    for page in range(2):
        _land(pages.repartition(1), landing, f"page = {page}")
    seen = []
    inner = P.append_pages
    monkeypatch.setattr(P, "append_pages", lambda s, files, *a, **k: (
        seen.append({r[0] for r in files.select("path").distinct().collect()}), inner(s, files, *a, **k))[1])
    per_run = pages.where("page = 0").count()
    result = load_incremental(spark, landing, raw, ledger, max_files_per_load=per_run)
    assert len(seen) == len(result.load_ids) == 2
    assert sum(map(len, seen)) <= 3  # two files, and one cut between two batches
    for load_id in result.load_ids:
        days = days_of_files(spark, raw, load_id)
        assert days.inputFiles() and all(load_folder("/raw", load_id) in f for f in days.inputFiles())
        assert 0 < days.count() <= per_run
    assert days_of_files(spark, raw, "nothing").count() == 0
    monkeypatch.setattr(L.CommitLog, "read", lambda *a: pytest.fail("a commit read an earlier entry"))
    one = spark.createDataFrame([("binance_klines/S/x",)], "source_file string")
    assert L.mark_loaded(one, ledger, "x") == 3


def test_batches_are_handed_over_in_order_and_the_first_failure_is_raised():
    import time

    from candlewick.plans.load import BATCHES_AT_ONCE, _ahead

    started, done = [], []

    def work(i):
        started.append(i)
        time.sleep(0.05 if i % 2 else 0.01)
        if i == 5:
            raise RuntimeError("batch 5")
        return i * i

    with pytest.raises(RuntimeError, match="batch 5"):
        for i, square in _ahead(work, range(30)):
            assert square == i * i
            done.append(i)
    assert done == list(range(5)) and max(started) < 5 + BATCHES_AT_ONCE
    assert list(_ahead(work, [])) == []
