"""Token counts through a digest cache.

The cache is a Parquet table of (content digest, tokenizer version digest) ->
n_tokens in shared storage. Documents are joined to it by digest; only distinct
texts that it lacks are encoded, and their counts are appended.

A text's normalised content is its bytes with null as empty text: byte-level
tokenizers give different counts for anything more, so nothing else is folded.

Hot contents: the distinct step is a combinable aggregate, so copies meet as
one row per map task, and the final join lets Spark split a skewed digest.

Defined results: null or empty text has 0 bytes and 0 tokens; null ``doc_id``
stays null; repeated rows are counted each; an empty table gives no rows; other
input columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import bpe
from candlewick.llm.common import file_system, scratch, stored, text_or_empty

CACHE = "tokenizer string, digest binary, n_tokens long"


@functools.lru_cache(maxsize=8)
def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file and the library that reads it."""
    import sentencepiece
    import tokenizers

    library = f"sentencepiece {sentencepiece.__version__}" if path.endswith(".model") \
        else f"tokenizers {tokenizers.__version__}"
    with open(path, "rb") as f:
        return hashlib.sha256(library.encode() + b"\n" + f.read()).hexdigest()


@functools.lru_cache(maxsize=4)
def _sentencepiece(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def count_tokens(path: str, texts: list[str]) -> list[int]:
    """Counts without begin, end or added special tokens; the library is chosen by file name."""
    if path.endswith(".model"):
        return [len(ids) for ids in _sentencepiece(path).encode(texts, num_threads=1)]
    return [len(ids) // 4 for ids in bpe.encoder(path).encode(texts)]


def _count(path: str):
    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            texts, counts = batch.column(1).to_pylist(), []
            for a, b in bpe.slices(texts):
                counts += count_tokens(path, texts[a:b])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())],
                                             names=["digest", "n_tokens"])

    return run


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version (digest, n_tokens); empty if there is no table yet."""
    from pyarrow import fs

    system, path = file_system(cache)
    info = system.get_file_info(path)
    if info.type == fs.FileType.NotFound:
        return spark.createDataFrame([], CACHE).select("digest", "n_tokens")
    rows = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version)
    # two runs may have stored the same digest; both counts are equal
    return rows.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``) of every row.

    ``cache`` is a folder on shared storage that is kept between runs; the
    default is a new one under ``spark.checkpoint.dir``. Misses are encoded and
    appended before the result is built.
    """
    spark = docs.sparkSession
    cache = cache or scratch(spark, "token-cache")
    version = tokenizer_version(tokenizer)
    keyed = text_or_empty(docs, id_col, text_col).select(
        "doc_id", "text", F.unhex(F.sha2("text", 256)).alias("digest"),
        F.octet_length("text").cast("long").alias("n_bytes"))
    # copies meet in each map task first, so a hot text crosses the network once per task
    misses = (keyed.groupBy("digest").agg(F.first("text").alias("text"))
              .join(read_cache(spark, cache, version), "digest", "left_anti"))
    (misses.mapInArrow(_count(tokenizer), "digest binary, n_tokens long")
     .select(F.lit(version).alias("tokenizer"), "digest", "n_tokens")
     .write.mode("append").partitionBy("tokenizer").parquet(cache))
    counts = stored(read_cache(spark, cache, version), "token-counts")  # apart from the join, whose hot digests Spark splits
    return (keyed.drop("text").join(counts, "digest")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
