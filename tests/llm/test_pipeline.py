"""The corpus pipeline on odd input: nulls, repeated rows, ties, extra and clashing columns, an empty table."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from candlewick.llm.common import _made, scratch, scratch_scope, table
from candlewick.storage import exists

WORDS = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "theta", "river", "stone"]


def text(seed, n=120):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice(WORDS)}{rng.randrange(50)}" for _ in range(n))


def long_text(n):
    return " ".join(f"{WORDS[i % 10]}{i * 7919 % 100_003}" for i in range(n))


@pytest.fixture()
def odd_folder(spark, tmp_path):
    """A documents table with nulls in every column, and names that clash with the operators' own."""
    rows = [(1, text(1), "en", "s", 5), (1, text(1), "en", "s", 5), (2, text(2), None, None, None), (None, text(3), "x", "s", 1),
            (None, text(3), "x", "s", 1), (None, text(4), "x", None, 1), (3, None, "en", "s", 0), (4, "", None, "s", 0),
            (5, text(5) + " more", "en", "s", 1), (6, text(5), "en", "s", 1), (7, long_text(20_000), "en", "s", 1),
            (7, text(8), "en", "s", 1), (8, f"{text(9, 60)}\n{text(10, 60)}", "en", "s", 1),
            (9, f"{text(9, 60)}\n{text(11, 60)}", "en", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df = df.withColumns({c: F.lit(c) for c in ("row", "key", "id", "n", "words", "kept", "ids", "least")})
    df.write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, "/root/testdata/sf0.001", "benchmark").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_odd_rows_go_through_all_stages(spark, odd_folder):
    docs = table(spark, odd_folder, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, odd_folder)
        assert kept.columns == docs.columns
        docs = spark.createDataFrame(kept.collect(), docs.schema)
    ids = sorted(str(r["doc_id"]) for r in docs.collect())
    assert ids == sorted(map(str, [1, 2, None, None, 5, 7, 7, 8, 9]))  # a row of each text; 6 resembles 5
    assert all(r["n_chars"] is None or r["n_chars"] == len(r["text"]) for r in docs.collect())
    (nine,) = [r["text"] for r in docs.collect() if r["doc_id"] == 9]
    assert nine == text(11, 60)
    pieces = corpus_pipeline.run(spark, odd_folder)
    assert sorted(set(str(r["doc_id"]) for r in pieces.collect())) == sorted(set(ids))


def test_empty_table(spark, odd_folder, tmp_path):
    table(spark, odd_folder, "documents").where("false").write.parquet(f"{tmp_path}/none/documents.parquet")
    table(spark, odd_folder, "benchmark").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []


def test_scratch_of_a_stage_is_deleted(spark):
    before = list(_made)
    with scratch_scope(spark):
        path = scratch(spark, "scope-test")
        spark.range(3).write.parquet(path)
        assert exists(spark, path)
    assert not exists(spark, path) and _made == before
