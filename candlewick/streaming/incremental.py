"""Landed pages -> raw table as a Structured Streaming job.

What streams is the news, not the candles: the rows of the landing log (one per
page and landing run) and the paths of pages landed one file each. The file
sources remember in the checkpoint which log and page files they have
processed. Each micro-batch loads its pages like a batch of the daily load and
is committed through the same ledger, under a load id made of the checkpoint's
id and the batch's number (two checkpoints never share one): its rows are
written as that load's partitions (a repeated micro-batch overwrites them), then
one ledger commit makes them visible and withdraws the rows that an earlier
load or batch held for the same pages. So a page that is landed again (the
resume rule does that to each symbol's last page every run) replaces itself
instead of doubling, a page that the landing withdrew loses its rows, and the
stream and the ledgered load may feed one table. One writer at a time is assumed.

A page whose file cannot be read does not stop the stream: it goes to the
reject table (source_file, path, reason, load_id) and the others are loaded;
landed again whole, it comes in with that log row or file. ``archive`` moves
one-file pages out of the landing folder once their batch is done.

``trigger(availableNow=True)`` processes what is there and stops, which fits a
daily schedule. Other files under the landing root do not disturb the stream.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick.operators.ledger import replace_loaded, unmark
from candlewick.plans.load import append_pages
from candlewick.schema import LOADED, RAW_PARTITIONS
from candlewick.sources.landing import LOG_SCHEMA, OWN, _single_files, scan_landing
from candlewick.sources.raw import days_of_files, ensure_raw_table
from candlewick.storage import make_folder

LISTED_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
NEWS = ["source_file", "event", "seq", "run", "path"]
REJECT_SCHEMA = "source_file string, path string, reason string, load_id string"


def landed_stream(spark: SparkSession, landing_root: str, max_files_per_trigger: int | None = None,
                  archive: str | None = None) -> DataFrame:
    """Streaming rows of landed and withdrawn pages (``NEWS``), without their candles."""
    make_folder(spark, f"{landing_root}/{OWN}/log")
    log = spark.readStream.schema(LOG_SCHEMA)
    singles = spark.readStream.format("binaryFile").schema(LISTED_SCHEMA) \
        .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    if max_files_per_trigger:
        log = log.option("maxFilesPerTrigger", str(max_files_per_trigger))
        singles = singles.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive:
        singles = singles.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    logged = log.parquet(f"{landing_root}/{OWN}/log").withColumnRenamed("file", "path")
    listed = _single_files(singles.load(landing_root).select("path")).withColumns(
        {"event": F.lit(LOADED), "seq": F.lit(None).cast("long")})
    return logged.select(*NEWS).unionByName(listed.select(*NEWS))


def _checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a checkpoint: the same for all runs of it, another for every new one."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()[0])["id"]


def _overwrite_raw(rows: DataFrame, path: str) -> None:
    parts = [c for c in RAW_PARTITIONS if c in rows.columns]
    rows.hint("rebalance", *parts).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def load_news(spark: SparkSession, news: DataFrame, landing_root: str, raw_path: str, ledger_path: str,
              load_id: str, rejects: str | None = None) -> None:
    """Load one micro-batch of landing news under ``load_id``. A page is taken as the landing has it
    now: pages withdrawn or replaced since are not loaded from an older run."""
    pages = scan_landing(spark, landing_root)
    names = news.select("source_file").distinct()
    files = pages.join(names, "source_file", "left_semi")
    loaded, bad = append_pages(spark, files, raw_path, load_id, append=_overwrite_raw)
    if bad and rejects:
        reasons = spark.createDataFrame(bad, "path string, reason string")
        files.join(reasons, "path").select("source_file", "path", "reason", F.lit(load_id).alias("load_id")) \
            .write.mode("append").parquet(rejects)
    marked = loaded.select("source_file").distinct().join(days_of_files(spark, raw_path, load_id), "source_file", "left")
    replace_loaded(spark, marked, ledger_path, load_id)
    gone = names.join(pages.select("source_file"), "source_file", "left_anti")
    if not gone.isEmpty():
        unmark(spark, gone, ledger_path)


def stream_to_raw(spark: SparkSession, landing_root: str, raw_path: str, ledger_path: str, checkpoint: str,
                  available_now: bool = True, max_files_per_trigger: int | None = None,
                  rejects: str | None = None, archive: str | None = None) -> StreamingQuery:
    """Start the streaming load; with ``available_now`` it stops once caught up."""
    ensure_raw_table(spark, raw_path)

    def commit(batch: DataFrame, number: int) -> None:
        load_id = f"stream-{_checkpoint_id(spark, checkpoint)}-{number:012d}"
        load_news(batch.sparkSession, batch, landing_root, raw_path, ledger_path, load_id, rejects)

    writer = (landed_stream(spark, landing_root, max_files_per_trigger, archive).writeStream
              .option("checkpointLocation", checkpoint).foreachBatch(commit))
    writer = writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_stream_once(spark: SparkSession, landing_root: str, raw_path: str, ledger_path: str,
                    checkpoint: str, rejects: str | None = None, archive: str | None = None) -> None:
    """Process every page landed so far, then return."""
    q = stream_to_raw(spark, landing_root, raw_path, ledger_path, checkpoint, rejects=rejects, archive=archive)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
