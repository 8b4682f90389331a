"""Spark session settings the library relies on.

Every candle timestamp is a UTC instant and every ``date`` is a UTC calendar
day, so the session time zone must be UTC before any read or date derivation.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from candlewick import storage


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "candlewick", extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs. On a cluster, pass the cluster's own
    master and leave shuffle partitions to AQE (see README, "Scale")."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC (dates and timestamps are UTC in the model)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch tables.

    Uses the cluster's ``spark.checkpoint.dir`` when it is set. Only a local
    session without one (tests, laptops) gets a fresh folder under the system
    temp directory; a cluster session without the setting is an error, since a
    machine-local folder is not visible to other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext handle
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
        return configured
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the object store)")
    path = tempfile.mkdtemp(prefix="candlewick-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir() or path
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """URI of a new folder under the checkpoint folder for one job's tables; the first write makes it."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_once(df: DataFrame, folder: str) -> DataFrame:
    """``df`` written as Parquet to a new folder and read back: what reads it more than once reads the
    same rows, and a lost executor recomputes from this table, not from what came before."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder once nothing reads it."""
    storage.delete(spark, path)
