"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.session import checkpoint_dir, remove_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_made: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """URI of a new folder under the shared checkpoint folder (not created yet)."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the scratch folders that were made in it. Results built in it must be written by then."""
    start = len(_made)
    try:
        yield
    finally:
        for path in _made[start:]:
            remove_folder(spark, path)
        del _made[start:]


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back. Cuts the lineage:
    later stages re-read the table instead of recomputing it when executors are lost."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(uri: str):
    """(Arrow file system, path) of a folder or file URI; both driver and executors may call it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("file:") else "file://" + uri[5:])


def text_or_empty(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns every text operator reads: id as long, null text as empty text."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
