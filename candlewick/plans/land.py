"""Landing job (S1-S8): fetched pages -> landed full pages, as the reference's extraction ends a run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.session import remove_folder, scratch_dir, write_once
from candlewick.sources.landing import remove_short_pages, write_landing
from candlewick.sources.pages import good_candles, open_pages, rejected_values, rejects_of


@dataclass
class LandResult:
    candles: int      # landed
    rejected: int     # values that are no numbers
    withdrawn: int    # pages landed before that have come back short


def land_pages(pages: DataFrame, root: str, limit: int, rejects: str | None = None) -> LandResult:
    """Land the pages (symbol, body) that hold ``limit`` candles or more, and withdraw what was landed
    of pages that come back shorter (S5).

    A body is parsed once. Without ``rejects``, a malformed number stops the job before anything is
    landed; with it, the values go to that table (symbol, page_start, pos, column, value), candles
    that have one are left out, and the others of their page are landed.
    """
    spark = pages.sparkSession
    opened = open_pages(pages.select("symbol", "body")).withColumn("page_start", F.col("rows")[0][0].cast("bigint"))
    folder = scratch_dir(spark, "landing-pages")
    parsed = write_once(rejects_of(opened.where(F.size("rows") >= limit)), folder)
    bad = rejected_values(parsed)
    rejected = bad.count()
    if rejected and rejects is None:
        shown = "; ".join(f"{r.symbol} {r.column}={r.value!r}" for r in bad.limit(5).collect())
        remove_folder(spark, folder)
        raise ValueError(f"{rejected} values are no numbers: {shown}")
    if rejected:
        bad.write.mode("append").parquet(rejects)
    good = good_candles(parsed)
    candles = good.count()
    if candles:
        write_landing(good, root)
    withdrawn = remove_short_pages(spark, pages, root, limit)
    remove_folder(spark, folder)
    return LandResult(candles, rejected, withdrawn)
