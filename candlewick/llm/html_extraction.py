"""HTML extraction: the maximum-scoring run of words (positive) and tags (negative).

Weights are learned on the driver from at most ``sample`` labelled pages: pages
whose url ends in the number of a document with known text. Every page is then
scanned whole, in its own task, with the broadcast weights.

Defined results: null or empty html, or html without words, gives empty text; a
null page_id or url stays null; repeated rows are extracted each; without
labelled pages fixed weights are used; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import html_region
from candlewick.llm.bpe import slices
from candlewick.llm.samples import chosen_keys, texts_of

NUMBER_AT_END = r"/(\d{1,18})(?:\.html?|/)?(?:[?#].*)?$"


def labelled_pages(pages: DataFrame, docs: DataFrame, sample: int = 400) -> list[tuple[str, str]]:
    """(html, text) of about ``sample`` distinct pages whose url ends in a document's id."""
    numbered = (pages.select(F.expr(f"try_cast(regexp_extract(url, r'{NUMBER_AT_END}', 1) as long)").alias("doc_id"),
                             "html").where("doc_id is not null and html is not null"))
    numbered = numbered.withColumn("key", F.xxhash64("doc_id", "html"))
    keys = chosen_keys(numbered.withColumn("all", F.lit(0)), ["all"], most=sample)
    chosen = texts_of(numbered.withColumn("all", F.lit(0)).withColumn("page", F.struct("doc_id", "html")), keys,
                      ["all"], "page").select("text.*")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).where("text is not null")
    rows = (texts.join(F.broadcast(chosen), "doc_id")  # about ``sample`` pages
            .groupBy("doc_id", "html").agg(F.min("text").alias("text")).collect())
    return sorted((r["html"], r["text"]) for r in rows)


def learn(pages: DataFrame, docs: DataFrame, sample: int = 400) -> html_region.Weights:
    return html_region.learn(labelled_pages(pages, docs, sample))


def _extract(weights):
    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            pages = [p or "" for p in batch.column(2).to_pylist()]
            for a, b in slices(pages):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(1)[a:b],
                     pa.array([html_region.main_text(p, weights.value) for p in pages[a:b]], pa.string())],
                    names=["page_id", "url", "text"])

    return run


def extract(pages: DataFrame, weights: html_region.Weights | None = None) -> DataFrame:
    """page_id, url, text (blocks of the main text, one a line) and n_chars of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(weights or html_region.Weights())  # a few hundred numbers
    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
            .mapInArrow(_extract(sent), "page_id long, url string, text string")
            .withColumn("n_chars", F.char_length("text").cast("long")))
