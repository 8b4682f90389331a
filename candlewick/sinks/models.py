"""Model materialization (S25): versioned day folders behind one pointer.

    <warehouse>/<table>/v=<version>/date=<day>/part-*.parquet   never changed once written
    <warehouse>/_snapshots/000000000012.json                    which version of each day is live

A run writes new versions of the days it rebuilds, of all tables, and then one
small snapshot file: the pointer moves for all tables at once. A run that stops
anywhere before leaves the old tables whole; its folders are never looked at.
Readers resolve the newest snapshot to the live day folders, so days that are
not asked for are not even listed. Versions that the last snapshots do not name
are deleted after a commit (``KEEP`` snapshots back, for readers that started
before it).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from candlewick.storage import CommitLog, child_names, delete

KEEP = 2
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


def day_name(day: dt.date | None) -> str:
    return NULL_DAY if day is None else day.isoformat()


@dataclass
class Snapshot:
    """Live versions by table and day, and how far the ledger is reflected in them."""

    number: int = 0
    days: dict[str, dict[str, str]] = field(default_factory=dict)    # table -> day -> version
    schemas: dict[str, str] = field(default_factory=dict)
    consumed: dict[str, int] = field(default_factory=dict)           # symbol ("" for all) -> ledger commit


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/_snapshots")

    def current(self) -> Snapshot:
        """The newest snapshot; an empty one if there is none."""
        newest = max(self.log.numbers(), default=0)
        return Snapshot(newest, **self.log.read(newest)) if newest else Snapshot()

    def write(self, table: str, df: DataFrame, observed: Observation | None = None, metrics: tuple = (),
              rebalance: bool = True) -> dict[str, str]:
        """Write a new version of the days in ``df`` (a ``date`` column). Returns day -> version; the
        rows are live once a snapshot names them. ``metrics`` are counted on the way, without a scan.

        ``rebalance`` shuffles the rows by day first, so each day gets a few right-sized files (AQE
        splits a big day) instead of one small file per task and day; pass False when the input
        already follows the days (staging read from the day-partitioned raw table)."""
        version = uuid.uuid4().hex
        out = df.observe(observed, *metrics) if observed is not None else df
        out = out.hint("rebalance", "date") if rebalance else out
        folder = f"{self.root}/{table}/v={version}"
        out.write.partitionBy("date").parquet(folder)
        return {n[len("date="):]: version for n in child_names(self.spark, folder) if n.startswith("date=")}

    def read_days(self, table: str, days: dict[str, str], schema: T.StructType) -> DataFrame:
        """Rows of the given day -> version folders, as a table partitioned by ``date``."""
        if not days:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/{table}"
        full = T.StructType([*schema.fields, T.StructField("v", T.StringType())])
        paths = [f"{base}/v={v}/date={d}" for d, v in sorted(days.items())]
        return self.spark.read.schema(full).option("basePath", base).parquet(*paths).drop("v") \
            .select(*schema.fieldNames())

    def read(self, table: str, snapshot: Snapshot | None = None) -> DataFrame:
        """The live rows of a table."""
        snapshot = snapshot or self.current()
        if table not in snapshot.days:
            raise ValueError(f"no table {table} in {self.root}")
        schema = T.StructType.fromJson(json.loads(snapshot.schemas[table]))
        return self.read_days(table, snapshot.days[table], schema)

    def commit(self, old: Snapshot, days: dict[str, dict[str, str]], schemas: dict[str, str],
               consumed: dict[str, int]) -> Snapshot:
        """Move the pointer: all tables at once. Fails if another writer was faster."""
        new = Snapshot(old.number + 1, {**old.days, **days}, {**old.schemas, **schemas}, consumed)
        self.log.append(new.number, {"days": new.days, "schemas": new.schemas, "consumed": consumed})
        self.vacuum()
        return new

    def vacuum(self, keep: int = KEEP) -> int:
        """Delete versions that none of the newest ``keep`` snapshots names, and older snapshots."""
        numbers = self.log.numbers()
        live = [self.log.read(n)["days"] for n in numbers[-keep:]]
        for n in numbers[:-keep]:
            self.log.delete(n)
        removed = 0
        for table in {t for days in live for t in days}:
            named = {v for days in live for v in days.get(table, {}).values()}
            for name in child_names(self.spark, f"{self.root}/{table}"):
                if name.startswith("v=") and name[2:] not in named:
                    removed += delete(self.spark, f"{self.root}/{table}/{name}")
        return removed


def read_model(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """The live rows of one model table of a warehouse."""
    return Warehouse(spark, warehouse).read(table)
