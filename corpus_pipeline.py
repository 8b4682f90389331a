"""The corpus pipeline: documents to packed training sequences.

Each stage works on all documents its predecessor kept and returns the columns
of ``documents``, extra ones included; the last one returns the pieces of the
packed sequences.

Defined results: a null or empty text fails the quality rules (too few words);
rows without a doc_id are told apart by their texts and stay unless a stage
rejects them; of repeated rows, and of rows tied for the smallest doc_id of a
group, one stays after the similarity join; an empty table gives no pieces.
What a stage stores under the checkpoint folder is deleted once its result is
written; the last stage's result is lazy, and so are its stored tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import decontamination, jaccard_join, line_dedup, packing, quality
from candlewick.llm.common import scratch, scratch_scope, table, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current quality policy."""
    return quality.kept_documents(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier document holds."""
    rows = line_dedup.deduplicated(docs)
    new = {"text": F.when(F.col("row.text").isNotNull(), F.col("kept")),
           "n_chars": F.when(F.col("row.n_chars").isNotNull(), F.char_length("kept").cast(docs.schema["n_chars"].dataType))}
    return rows.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents: the one with the smallest doc_id."""
    return jaccard_join.distinct_documents(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with the checksum of their ids."""
    pieces = packing.pack(docs, tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", sequence_packing),
]

#: Tokenizer ids, components and packing are beyond plain SQL; the tests hold each stage to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage is written as Parquet and read back for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name.lower().replace(' ', '-')}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
