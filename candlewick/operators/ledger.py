"""Load ledger (S16-S19, S21, S22): which landed pages the raw table holds.

A commit log of events ``(source_file, loaded_at, load_id, event, days, seq)``
with ``event`` either ``loaded`` or ``removed``. A file is active under a load
when it has a ``loaded`` event for that load and no ``removed`` event for it.
Nothing is ever rewritten in place: un-marking a file appends a tombstone.

    <ledger>/commits/000000000007.json   one commit: its load, counts, folder of events
    <ledger>/events/<id>/event=.../      that commit's events, loads and tombstones apart
    <ledger>/snapshots/000000000064.json the state after a commit: loads, folder of its rows
    <ledger>/state/<id>/event=.../       active files, and the tombstones still needed

A commit is there when its JSON file is, and that file appears whole or not at
all. Every ``COMPACT_EVERY`` commits the state is written as a snapshot, in which
tombstones have removed the loads they cancel; readers take the newest snapshot
and the commits since. ``days`` names the calendar days that hold the file's
candles, so a refresh finds the touched days here and not in the raw rows.
One writer at a time is assumed; a second one fails on the commit's number.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from candlewick.schema import LEDGER_SCHEMA, LOADED, REMOVED
from candlewick.storage import CommitLog, exists

#: Commits between two snapshots.
COMPACT_EVERY = 64
COLUMNS = LEDGER_SCHEMA.fieldNames()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists."""
    return exists(spark, path)


@dataclass
class LedgerLog:
    """What the driver knows of a ledger without reading an event: the newest snapshot, later commits."""

    path: str
    last: int = 0
    snapshot: dict | None = None
    commits: list[dict] = field(default_factory=list)

    def parts(self) -> list[dict]:
        return ([self.snapshot] if self.snapshot else []) + self.commits

    def load_ids(self) -> list[str]:
        return sorted({i for p in self.parts() for i in p["loads"]})

    def folders(self, event: str) -> list[str]:
        return [f"{self.path}/{p['events']}/event={event}" for p in self.parts() if p[event]]


def _entries(spark: SparkSession, path: str, after: int) -> list[dict]:
    log = CommitLog(spark, f"{path}/commits")
    return [{**log.read(n), "seq": n} for n in log.numbers() if n > after]


def ledger_log(spark: SparkSession, path: str) -> LedgerLog:
    """One listing of each log folder and the few small files after the newest snapshot."""
    path = path.rstrip("/")
    snapshots = CommitLog(spark, f"{path}/snapshots")
    newest = max(snapshots.numbers(), default=0)
    commits = _entries(spark, path, newest)
    return LedgerLog(path, commits[-1]["seq"] if commits else newest,
                     snapshots.read(newest) if newest else None, commits)


def _read(spark: SparkSession, log: LedgerLog, *events: str) -> DataFrame:
    folders = {e: log.folders(e) for e in events}
    parts = [spark.read.schema(LEDGER_SCHEMA).parquet(*f).withColumn("event", F.lit(e))
             for e, f in folders.items() if f]
    if not parts:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return reduce(DataFrame.unionByName, parts).select(*COLUMNS)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's state as events (empty when there is no ledger yet)."""
    return _read(spark, ledger_log(spark, path), LOADED, REMOVED)


def tombstones(spark: SparkSession, log: LedgerLog) -> DataFrame:
    """(load_id, source_file) whose raw rows are withdrawn."""
    return _read(spark, log, REMOVED).select("load_id", "source_file").distinct()


def events_after(spark: SparkSession, path: str, seq: int) -> tuple[DataFrame, int]:
    """(events of all commits after ``seq``, number of the last commit)."""
    commits = _entries(spark, path.rstrip("/"), seq)
    log = LedgerLog(path.rstrip("/"), commits=commits)
    return _read(spark, log, LOADED, REMOVED), commits[-1]["seq"] if commits else seq


def ensure_ledger(spark: SparkSession, path: str) -> None:
    """A ledger needs no file before its first commit; what is not there reads as empty."""


def active_files(ledger: DataFrame) -> DataFrame:
    """(source_file, load_id) pairs whose rows readers may see."""
    loaded = ledger.where(F.col("event") == LOADED).select("source_file", "load_id")
    removed = ledger.where(F.col("event") == REMOVED).select("source_file", "load_id")
    return loaded.join(removed, ["source_file", "load_id"], "left_anti").distinct()


def loaded_files(ledger: DataFrame) -> DataFrame:
    """The set of loaded files (one ``source_file`` column)."""
    return active_files(ledger).select("source_file").distinct()


def new_files_only(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Landed files not yet loaded (anti join on ``source_file``). No
    broadcast hint: the planner broadcasts the ledger side only when its size
    estimate is under the threshold, and shuffles it otherwise."""
    return files.join(loaded_files(ledger), "source_file", "left_anti")


def loaded_flags(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """S19 for many files at once: ``files`` plus a boolean ``is_loaded``."""
    hit = loaded_files(ledger).withColumn("is_loaded", F.lit(True))
    return files.join(hit, "source_file", "left") \
        .withColumn("is_loaded", F.coalesce("is_loaded", F.lit(False)))


def is_loaded(ledger: DataFrame, source_file: str) -> bool:
    """Whether one file is loaded (an action; stops at the first match)."""
    return not active_files(ledger).where(F.col("source_file") == source_file).isEmpty()


def _write_events(events: DataFrame, folder: str) -> dict[str, int]:
    """Write events, loads and tombstones apart; how many there were of each is counted on the way."""
    seen = Observation()
    counts = [F.count_if(F.col("event") == e).alias(e) for e in (LOADED, REMOVED)]
    # The rebalance makes small commits one file each and lets AQE split a large one.
    events.select(*COLUMNS).hint("rebalance").observe(seen, *counts).write.partitionBy("event").parquet(folder)
    return {e: seen.get.get(e) or 0 for e in (LOADED, REMOVED)}


def _commit(spark: SparkSession, events: DataFrame, path: str, loads: list[str]) -> int:
    """Append one commit of ``events`` (source_file, load_id, event, days); readers see all of it or
    none. Returns its number."""
    path = path.rstrip("/")
    snapshot = max(CommitLog(spark, f"{path}/snapshots").numbers(), default=0)  # only the numbers: no entry is read
    since = [n for n in CommitLog(spark, f"{path}/commits").numbers() if n > snapshot]
    last = max(since, default=snapshot)
    seq, folder = last + 1, f"events/{uuid.uuid4().hex}"
    rows = events.withColumns({"loaded_at": F.current_timestamp(), "seq": F.lit(seq).cast("long")})
    counts = _write_events(rows, f"{path}/{folder}")
    if not any(counts.values()):
        return last
    CommitLog(spark, f"{path}/commits").append(seq, {"loads": loads, "events": folder, **counts})
    if len(since) + 1 >= COMPACT_EVERY:
        compact(spark, path)
    return seq


def compact(spark: SparkSession, path: str) -> None:
    """Write the state as a snapshot: loads that a tombstone cancels are gone, the tombstones stay
    (their raw rows are still there)."""
    path = path.rstrip("/")
    log = ledger_log(spark, path)
    if not log.commits:
        return
    events = read_ledger(spark, path)
    removed = events.where(F.col("event") == REMOVED).dropDuplicates(["source_file", "load_id"])
    active = events.where(F.col("event") == LOADED).join(
        removed.select("source_file", "load_id"), ["source_file", "load_id"], "left_anti")
    folder = f"state/{uuid.uuid4().hex}"
    counts = _write_events(active.dropDuplicates(["source_file", "load_id"]).unionByName(removed), f"{path}/{folder}")
    CommitLog(spark, f"{path}/snapshots").append(log.last, {"loads": log.load_ids(), "events": folder, **counts})


def _with_days(files: DataFrame) -> DataFrame:
    days = F.col("days") if "days" in files.columns else F.lit(None)
    return files.select("source_file", days.cast(LEDGER_SCHEMA["days"].dataType).alias("days"))


def mark_loaded(files: DataFrame, path: str, load_id: str) -> int:
    """Record ``files`` (a ``source_file`` column, and ``days`` where known) as loaded by
    ``load_id``, stamped with the current time. Call only after the raw rows are written."""
    rows = _with_days(files).dropDuplicates(["source_file"])
    return _commit(files.sparkSession, rows.withColumns({"load_id": F.lit(load_id), "event": F.lit(LOADED)}),
                   path, [load_id])


def _tombstones_of(spark: SparkSession, files: DataFrame, path: str) -> DataFrame:
    """A tombstone, with its days, for every active load of ``files``."""
    ledger = read_ledger(spark, path)
    days = ledger.where(F.col("event") == LOADED).dropDuplicates(["source_file", "load_id"]) \
        .select("source_file", "load_id", "days")
    hits = active_files(ledger).join(files.select("source_file").distinct(), "source_file", "left_semi")
    return hits.join(days, ["source_file", "load_id"], "left").withColumn("event", F.lit(REMOVED))


def replace_loaded(spark: SparkSession, files: DataFrame, path: str, load_id: str) -> int:
    """Record ``files`` as loaded by ``load_id`` and withdraw them from every other load, in one
    commit: readers go from the old rows to the new ones at once. Doing it again changes nothing."""
    new = _with_days(files).dropDuplicates(["source_file"]).withColumns(
        {"load_id": F.lit(load_id), "event": F.lit(LOADED)})
    held = active_files(read_ledger(spark, path)).where(F.col("load_id") == load_id)
    new = new.join(held, ["source_file", "load_id"], "left_anti")
    old = _tombstones_of(spark, files, path).where(F.col("load_id") != load_id)
    return _commit(spark, new.unionByName(old), path, [load_id])


def unmark(spark: SparkSession, files: DataFrame, path: str) -> int:
    """Withdraw ``files`` from every load that holds them (tombstones). Their
    raw rows become invisible and the next incremental load picks them up again."""
    return _commit(spark, _tombstones_of(spark, files, path), path, [])
