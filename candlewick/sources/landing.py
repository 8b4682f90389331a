"""Landed candle files.

A landing run writes its pages into a few data files of one folder, then one
log file that names them:

    <root>/_landed/data/<run>/part-*.parquet     candles with source_file
    <root>/_landed/log/000000000007-<run>.parquet  one row per page: event, run, file, rows

A run is there when its log file is (it appears whole or not at all), and a
page is what the newest log row of its name says: landed again (the resume
point re-fetches the last page, T10) it replaces itself, withdrawn (S5) it is
gone. Finding all pages reads the log, lists no data folder and opens no data
file. A page's name is the reference's file name, built by
:func:`candlewick.functions.paths.landing_path`; it is the page's identity in
the load ledger, and the symbol and start time are parsed from it.

Pages landed one file each are read too: at the reference's own paths (S7), and
as ``symbol=<SYM>/page=<yyyy-MM-dd-HHmm>/part-*.parquet`` (our first layout).
Only if such folders are there are they listed.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.paths import landing_path, matches_landing, path_start_ms, symbol_from_path
from candlewick.schema import LANDED_SCHEMA, LOADED, REMOVED
from candlewick.storage import child_names, delete, make_folder, move

OWN = "_landed"
PAGE_KEY_FORMAT = "yyyy-MM-dd-HHmm"
PART_PATTERN = r"/symbol=([^/]+)/page=(\d{4}-\d{2}-\d{2}-\d{4})/[^/]+\.parquet$"
RUN_PATTERN = rf"/{OWN}/data/([0-9a-f]+)/"
LOG_SCHEMA = "source_file string, event string, seq long, run string, file string, rows long"
OWN_SCHEMA = T.StructType([*LANDED_SCHEMA.fields, T.StructField("source_file", T.StringType())])


def page_key(start_ms) -> F.Column:
    return F.date_format(F.timestamp_millis(F.col(start_ms) if isinstance(start_ms, str)
                                            else start_ms), PAGE_KEY_FORMAT)


def _log_names(spark: SparkSession, root: str) -> list[str]:
    return [n for n in child_names(spark, f"{root}/{OWN}/log") if n.endswith(".parquet") and n[0].isdigit()]


def _append_log(rows: DataFrame, root: str, run: str) -> None:
    """Commit a landing run's log rows (one per page) as one file."""
    spark, folder = rows.sparkSession, f"{root}/{OWN}/log"
    make_folder(spark, folder)
    names = _log_names(spark, root)
    seq = int(names[-1].split("-")[0]) + 1 if names else 1
    aside = f"{folder}/_aside-{run}"
    rows.withColumn("seq", F.lit(seq).cast("long")).select(*[c.split()[0] for c in LOG_SCHEMA.split(", ")]) \
        .coalesce(1).write.parquet(aside)
    parts = [n for n in child_names(spark, aside) if n.endswith(".parquet")]
    if parts:
        move(spark, f"{aside}/{parts[0]}", f"{folder}/{seq:012d}-{run}.parquet")
    delete(spark, aside)


def write_landing(parsed: DataFrame, root: str, start_col: str = "page_start") -> None:
    """Land parsed full pages. No shuffle: a page arrives as one row and is exploded inside one
    task, so it lies in one file; a file holds all pages of its task."""
    spark, run = parsed.sparkSession, uuid.uuid4().hex
    cols = [f.name for f in LANDED_SCHEMA]
    folder = f"{root}/{OWN}/data/{run}"
    parsed.select(*cols, landing_path("symbol", start_col).alias("source_file")).write.parquet(folder)
    written = spark.read.schema(OWN_SCHEMA).parquet(folder).groupBy("source_file", F.col("_metadata.file_path").alias("file"))
    _append_log(written.agg(F.count(F.lit(1)).alias("rows"))
                .withColumns({"event": F.lit(LOADED), "run": F.lit(run)}), root, run)


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """The log rows that stand: those of each page's newest run."""
    if not _log_names(spark, root):
        return spark.createDataFrame([], LOG_SCHEMA)
    log = spark.read.schema(LOG_SCHEMA).parquet(f"{root}/{OWN}/log")
    newest = log.groupBy("source_file").agg(F.max("seq").alias("seq"))
    return log.join(newest, ["source_file", "seq"])


def _source_of(path_col: F.Column) -> tuple[F.Column, F.Column, F.Column]:
    """(symbol, page start, name) of a page landed as one file; null symbol if the path is not one."""
    own = F.nullif(F.regexp_extract(path_col, PART_PATTERN, 1), F.lit(""))
    sym = F.coalesce(own, symbol_from_path(path_col, strict=False))
    stamp = F.regexp_extract(path_col, PART_PATTERN, 2)
    start = F.when(own.isNotNull(), F.unix_millis(F.to_timestamp(stamp, PAGE_KEY_FORMAT))) \
        .otherwise(path_start_ms(path_col))
    return sym, start, landing_path(sym, start)


def _single_files(files: DataFrame) -> DataFrame:
    """Pages among listed files (``path``); what is not shaped like one is skipped."""
    part = files.where(F.col("path").rlike(PART_PATTERN) | matches_landing("path"))
    sym, start, source = _source_of(F.col("path"))
    return part.select("path", sym.alias("symbol"), start.alias("page_start"), source.alias("source_file"),
                       F.lit(None).cast("string").alias("run")).where(matches_landing("source_file"))


def scan_landing(spark: SparkSession, root: str) -> DataFrame:
    """One row per landed page (and data file) with ``symbol``, ``page_start``, the page's
    name ``source_file``, its data file ``path`` and ``run``. Reads the log; folders of one-file
    pages next to it are listed, without reading content. A page in both is the log's."""
    logged = read_log(spark, root)
    pages = logged.where(F.col("event") == LOADED).select(
        F.col("file").alias("path"), symbol_from_path("source_file").alias("symbol"),
        path_start_ms("source_file").alias("page_start"), "source_file", "run")
    if not [n for n in child_names(spark, root) if not n.startswith(("_", "."))]:
        return pages
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
               .option("pathGlobFilter", "*.parquet").load(root).select("path"))
    others = _single_files(listing).join(logged.select("source_file"), "source_file", "left_anti")
    return pages.unionByName(others)


def withdrawn_pages(spark: SparkSession, root: str) -> DataFrame:
    """Names of pages whose newest log row withdraws them."""
    return read_log(spark, root).where(F.col("event") == REMOVED).select("source_file")


def read_landed(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Candles of the given pages (rows of :func:`scan_landing`) with their ``source_file``. The driver
    gets the names of the data files that hold them (one per task of a landing run, or per one-file page)."""
    cols = [f.name for f in LANDED_SCHEMA]
    found = files.select("path", F.col("run").isNull().alias("single")).distinct().collect()
    shared, singles = ([r["path"] for r in found if r["single"] == kind] for kind in (False, True))
    parts = []
    if shared:
        named = spark.read.schema(OWN_SCHEMA).parquet(*shared)
        run = F.regexp_extract(F.col("_metadata.file_path"), RUN_PATTERN, 1)
        parts.append(named.withColumn("run", run)
                     .join(files.select("source_file", "run").distinct(), ["source_file", "run"], "left_semi")
                     .select(*cols, "source_file"))
    if singles:
        df = (spark.read.schema(LANDED_SCHEMA).option("recursiveFileLookup", "true").parquet(*singles)
              .select(*cols, F.col("_metadata.file_path").alias("_file")))
        parts.append(df.select(*cols, _source_of(F.col("_file"))[2].alias("source_file")))
    if not parts:
        return spark.createDataFrame([], LANDED_SCHEMA).withColumn("source_file", F.lit(None).cast("string"))
    return reduce(DataFrame.unionByName, parts)


def unreadable_files(files: DataFrame) -> DataFrame:
    """(path, reason) of data files that cannot be read: executors open each file once, and check its
    footer, its column types and all its pages. The workers need no module of this package."""
    wanted = {f.name: f.dataType.simpleString() for f in LANDED_SCHEMA}

    def fault(path):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        types = {"bigint": (pa.int64(), pa.int32()), "double": (pa.float64(), pa.float32())}
        if path.startswith("file:/"):
            path = "file:///" + path[5:].lstrip("/")
        try:
            system, name = fs.FileSystem.from_uri(path)
            with system.open_input_file(name) as source, pq.ParquetFile(source) as file:
                have = file.schema_arrow
                for column, kind in wanted.items():
                    at = have.get_field_index(column)
                    if at >= 0 and have.field(at).type not in types[kind]:
                        return f"column {column} is {have.field(at).type}"
                for i in range(file.num_row_groups):
                    file.read_row_group(i)
        except (OSError, pa.ArrowException) as e:
            return f"{type(e).__name__}: {e}"[:500]
        return None

    def probe(batches):
        import pyarrow as pa

        for batch in batches:
            found = [(p, fault(p)) for p in batch.column(0).to_pylist()]
            bad = [x for x in found if x[1] is not None]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in bad], pa.string()),
                                              pa.array([r for _, r in bad], pa.string())], names=["path", "reason"])

    paths = files.select("path").distinct()
    return paths.repartition("path").mapInArrow(probe, "path string, reason string")


def write_reference_layout(parsed: DataFrame, root: str, page_cols: list[str],
                           start_col: str = "page_start") -> DataFrame:
    """Land each page as the one file that S7 names, below ``root`` (a local or mounted folder, or a
    URI that Arrow opens). One group is one page, so a task holds at most a page. Returns the files
    written (``source_file``, ``rows``); like any DataFrame it runs when it is used."""
    cols = [f.name for f in LANDED_SCHEMA]

    def write(pdf):
        import pandas as pd
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root)
        name = pdf["source_file"].iloc[0]
        system.create_dir(f"{base}/{name}".rsplit("/", 1)[0], recursive=True)
        table = pa.Table.from_pandas(pdf.sort_values("open_time")[cols], preserve_index=False)
        pq.write_table(table, f"{base}/{name}", filesystem=system)
        return pd.DataFrame({"source_file": [name], "rows": [len(pdf)]})

    named = parsed.withColumn("source_file", landing_path("symbol", start_col))
    return named.groupBy(*page_cols).applyInPandas(write, "source_file string, rows long")


def remove_short_pages(spark: SparkSession, pages: DataFrame, root: str, limit: int) -> int:
    """A page that comes back with fewer than ``limit`` candles is not kept, and neither is what
    an earlier run landed for it. ``pages`` are unparsed pages (symbol, body). The log withdraws the
    landed ones (the next load takes their rows out, see :mod:`candlewick.plans.load`); files of pages
    landed one file each -- at most one page a symbol and run -- are deleted by the driver. Returns
    how many pages were withdrawn."""
    from candlewick.sources.pages import page_size, page_start

    short = pages.where((page_size("body") < limit) & (page_size("body") > 0)).select(
        landing_path("symbol", page_start("body")).alias("source_file")).distinct()
    landed = scan_landing(spark, root).join(short, "source_file", "left_semi")
    found = landed.groupBy("source_file", "run").agg(F.collect_set("path").alias("paths")).collect()
    if not found:
        return 0
    run = uuid.uuid4().hex
    rows = [(r["source_file"], REMOVED, 0, run, None, 0) for r in found]
    _append_log(spark.createDataFrame(rows, LOG_SCHEMA).drop("seq"), root, run)
    for r in found:
        for path in r["paths"] if r["run"] is None else ():
            delete(spark, path)
    return len(found)


def latest_file(files: DataFrame) -> DataFrame:
    """Per symbol, the landed page with the latest start (by the name's
    date fields); symbols without files have no row."""
    start = path_start_ms("source_file")
    return files.select("symbol", "source_file", start.alias("_start")) \
        .groupBy("symbol").agg(F.max_by("source_file", "_start").alias("latest_file"),
                               F.max("_start").alias("latest_start"))


def resume_point(files: DataFrame, symbols: DataFrame, default_ms: int) -> DataFrame:
    """Where each configured symbol's extraction resumes -- the latest landed
    page's start minute (so that page is fetched again), else ``default_ms``.
    ``symbols`` is the configured pair list, one ``symbol`` column."""
    latest = latest_file(files)
    return symbols.join(latest, "symbol", "left").select(
        "symbol", F.coalesce("latest_start", F.lit(default_ms)).alias("start_time"))
