"""Incremental load of landed pages into the raw table, with the ledger as
the commit point (SURVEY §4b).

1. find landed pages (the landing log), drop those the ledger marks loaded (anti
   join), and store the list of new pages with its row numbers;
2. per batch of at most ``max_files_per_load`` pages: read only those pages,
   derive timestamps, symbol and day, append under a fresh ``load_id`` to the
   load's own folder; up to ``BATCHES_AT_ONCE`` batches are appended at a time;
3. in the batches' order, commit to the ledger exactly the pages read, with the days of their candles.

A crash before 3 leaves rows no reader sees; the retry loads the pages again
under a new id. Pages that the landing withdrew (S5) get tombstones. One
writer at a time is assumed.
"""

from __future__ import annotations

import uuid
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.numbering import with_row_index
from candlewick.functions.paths import symbol_from_path
from candlewick.operators.ledger import mark_loaded, new_files_only, read_ledger, unmark
from candlewick.session import remove_folder, scratch_dir, write_once
from candlewick.sources.landing import read_landed, scan_landing, unreadable_files, withdrawn_pages
from candlewick.sources.raw import append_raw, days_of_files, ensure_raw_table, load_folder, remove_load, to_raw


@dataclass
class LoadResult:
    load_id: str | None  # the last commit's id (None when nothing was new)
    files: int
    load_ids: list[str] = field(default_factory=list)
    failed: list[str] = field(default_factory=list)  # pages whose files could not be read


class CrashForTest(RuntimeError):
    """Raised by ``load_incremental(..., fail_before_commit=True)``."""


MAX_FILES_PER_LOAD = 200_000
#: Batches appended side by side; their commits stay in order.
BATCHES_AT_ONCE = 4


def append_pages(spark: SparkSession, files: DataFrame, raw_path: str, load_id: str,
                 append=append_raw) -> tuple[DataFrame, list]:
    """Append the candles of landed pages (rows of ``scan_landing``) to the raw table.

    Returns (the pages appended, [(path, reason)] of files that cannot be read).
    If the append fails, executors open every file of the batch once; the pages
    of those that cannot be read are left out and the rest is appended again,
    after the failed attempt's rows are deleted. If all files are sound, the
    error was something else and is raised.
    """
    def write(pages: DataFrame) -> None:
        landed = read_landed(spark, pages).withColumn("symbol", symbol_from_path("source_file"))
        append(to_raw(landed, load_id).drop("load_id"), load_folder(raw_path, load_id))

    try:
        write(files)
        return files, []
    except Exception:  # noqa: BLE001 - the files decide, not the kind of error
        bad = [tuple(r) for r in unreadable_files(files).collect()]  # broken files only
        if not bad:
            raise
    remove_load(spark, raw_path, load_id)
    broken = spark.createDataFrame(bad, "path string, reason string").select("path")
    lost = files.join(broken, "path", "left_semi").select("source_file").distinct()
    sound = files.join(lost, "source_file", "left_anti")
    write(sound)
    return sound, bad


def _ahead(work: Callable, items: Iterable) -> Iterator[tuple]:
    """(item, work(item)) in order, with up to ``BATCHES_AT_ONCE`` in work from driver threads. The
    first failure is raised when its turn comes; what has not started then is not started."""
    with ThreadPoolExecutor(max_workers=BATCHES_AT_ONCE) as pool:
        waiting, items = deque(), iter(items)
        try:
            while True:
                for item in islice(items, BATCHES_AT_ONCE - len(waiting)):
                    waiting.append((item, pool.submit(work, item)))
                if not waiting:
                    return
                item, job = waiting.popleft()
                yield item, job.result()
        finally:
            for _, job in waiting:
                job.cancel()


def load_incremental(spark: SparkSession, landing_root: str, raw_path: str, ledger_path: str,
                     fail_before_commit: bool = False,
                     max_files_per_load: int = MAX_FILES_PER_LOAD) -> LoadResult:
    """Load every landed page not yet in the ledger. The new pages are committed
    in batches of at most ``max_files_per_load`` pages, each its own load id and
    ledger commit, so a backfill is a series of bounded jobs: a failure redoes
    the batches in work, and the batches already committed stay.

    The list of new pages is a numbered table; a batch is a range of its
    numbers, so no list of names passes through the driver. Pages are numbered
    by data file, so a batch reads the files that hold its pages and few others'. A page whose file
    cannot be read does not stop the others: it is reported in ``failed`` and
    not marked, so a later run loads it once it is repaired."""
    ensure_raw_table(spark, raw_path)
    landed, ledger = scan_landing(spark, landing_root), read_ledger(spark, ledger_path)
    folder = scratch_dir(spark, "load-listing")
    pages = write_once(new_files_only(landed, ledger), f"{folder}/new")
    names = pages.groupBy("source_file").agg(F.min("path").alias("path"))
    names = write_once(with_row_index(names, ["path", "source_file"], f"{folder}/order"), f"{folder}/names")
    total = names.count()
    ids, failed, done = [], [], 0

    def append(start: int) -> tuple[str, DataFrame, DataFrame, list]:
        batch = names.where((F.col("index") >= start) & (F.col("index") < start + max_files_per_load))
        files = pages.join(batch.select("source_file"), "source_file", "left_semi")
        load_id = uuid.uuid4().hex
        return load_id, batch, *append_pages(spark, files, raw_path, load_id)

    for start, (load_id, batch, loaded, bad) in _ahead(append, range(0, total, max_files_per_load)):
        lost = [r[0] for r in batch.join(loaded.select("source_file"), "source_file", "left_anti")
                .select("source_file").collect()] if bad else []
        failed += lost
        if fail_before_commit:
            raise CrashForTest("stopped between the raw append and the ledger commit")
        # The commit names exactly the pages read: a page landed while the load runs is neither read nor marked.
        mark_loaded(loaded.select("source_file").distinct()
                    .join(days_of_files(spark, raw_path, load_id), "source_file", "left"), ledger_path, load_id)
        count = min(max_files_per_load, total - start) - len(lost)
        if count:
            ids.append(load_id)
        done += count
    withdrawn = withdrawn_pages(spark, landing_root)
    if not withdrawn.isEmpty():
        unmark(spark, withdrawn, ledger_path)
    remove_folder(spark, folder)
    return LoadResult(ids[-1] if ids else None, done, ids, failed)
