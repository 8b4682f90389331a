"""Raw candle table.

One Parquet table for all symbols, partitioned ``load_id / symbol / date``.
Rows keep their page's ``source_file``; a reader sees a row only when its
(load_id, source_file) is active in the ledger, so a load that crashed before
its ledger commit leaves an invisible orphan instead of duplicates (T6).
A load commits all its files in one ledger commit, which :func:`read_raw`
uses to turn visibility into partition pruning on ``load_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.time import fill_timestamps, trade_date
from candlewick.operators.ledger import ledger_log, path_exists, tombstones
from candlewick.schema import LEDGER_SCHEMA, RAW_PARTITIONS, RAW_SCHEMA, REMOVED
from candlewick.storage import delete


def ensure_raw_table(spark: SparkSession, path: str) -> None:
    """Create the (empty, partitioned) raw table if absent."""
    if not path_exists(spark, path):
        spark.createDataFrame([], RAW_SCHEMA).write.mode("overwrite") \
            .partitionBy(*RAW_PARTITIONS).parquet(path)


def to_raw(landed: DataFrame, load_id: str) -> DataFrame:
    """Landed rows (with ``symbol`` and ``source_file``) in raw-table shape, with both
    timestamps derived before the write (S23 at load time, T7)."""
    filled = fill_timestamps(landed)
    return filled.select(
        *[F.col(f.name).cast(f.dataType) for f in RAW_SCHEMA
          if f.name not in ("load_id", "date")],
        F.lit(load_id).alias("load_id"), trade_date("open_time_ts").alias("date"),
    ).select(*RAW_SCHEMA.fieldNames())


def append_raw(rows: DataFrame, path: str) -> None:
    """Append rows, day partitioned (under their load).

    The rebalance hint shuffles the batch by its partition columns so each
    (symbol, day) gets a few well-sized files instead of one small file per
    input task; AQE splits a hot (symbol, day) and merges small ones. Rows
    without ``load_id`` go to a load's own folder (:func:`load_folder`), which
    no other write touches, so several loads may be written at once."""
    parts = [c for c in RAW_PARTITIONS if c in rows.columns]
    rows.hint("rebalance", *parts).write.mode("append").partitionBy(*parts).parquet(path)


def load_folder(path: str, load_id: str) -> str:
    return f"{path.rstrip('/')}/load_id={load_id}"


def days_of_files(spark: SparkSession, path: str, load_id: str) -> DataFrame:
    """(source_file, days) of one load: the calendar days of each file's rows, the null day included.
    Reads two columns of that load's folder, and lists no other load's."""
    folder = load_folder(path, load_id)
    if not path_exists(spark, folder):  # no row was appended
        return spark.createDataFrame([], f"source_file string, days {LEDGER_SCHEMA['days'].dataType.simpleString()}")
    rows = spark.read.schema(RAW_SCHEMA).option("basePath", path).parquet(folder)
    return rows.groupBy("source_file").agg(F.collect_set(F.struct("date")).alias("days"))


def remove_load(spark: SparkSession, path: str, load_id: str) -> None:
    """Delete the rows of a load that was not committed."""
    delete(spark, load_folder(path, load_id))


def read_raw(spark: SparkSession, path: str, ledger_path: str | None = None,
             symbols: list[str] | None = None) -> DataFrame:
    """The visible raw rows; building the plan starts no job. ``symbols``
    prunes ``symbol=`` directories; a filter on ``date`` by the caller prunes
    days. Without a ledger every row is visible.

    A row is visible when its ``load_id`` is committed and its (load_id,
    source_file) has no tombstone. The committed ids are named in the ledger's
    log, so they become a partition filter: crashed loads' folders are never
    read. Tombstones lie in folders of their own, so the planner knows their
    size when it chooses how to anti-join them.
    """
    raw = spark.read.schema(RAW_SCHEMA).parquet(path)
    if symbols is not None:
        raw = raw.where(F.col("symbol").isin(symbols))
    if ledger_path is None:
        return raw
    log = ledger_log(spark, ledger_path)
    raw = raw.where(F.col("load_id").isin(log.load_ids()))  # partition pruning
    if not log.folders(REMOVED):
        return raw
    return raw.join(tombstones(spark, log), ["load_id", "source_file"], "left_anti")
