"""Registered queries: SQL where there is some, brute force elsewhere; and the pipeline."""

import os

import duckdb
import pytest

import corpus_pipeline
from candlewick.llm import decontamination, quality, registry
from candlewick.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def views():
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, views, name):
    got = registry.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = views.sql(registry.ORACLES[name])
    assert sorted(want.columns) == columns
    place = [want.columns.index(c) for c in columns]
    assert sorted(str([r[c] for c in columns]) for r in got.collect()) == \
        sorted(str([r[i] for i in place]) for r in want.fetchall())


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))


def test_similarity_query(spark):
    from test_dedup import linked

    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    got = registry.op8_jaccard_join(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(linked(rows))


def test_pipeline_stages(spark, monkeypatch):
    """Each stage against brute force on its own input, through ``run``."""
    from test_dedup import contaminated, deduplicated, linked
    from test_tokens import packed, ids_of

    seen = []
    stages = [(n, lambda s, d, sf, f=f: seen.append(d) or f(s, d, sf)) for n, f in corpus_pipeline.STAGES]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    last = corpus_pipeline.run(spark, SF).collect()
    inputs = [{r["doc_id"]: r for r in d.collect()} for d in seen]
    assert all(d.columns == seen[0].columns for d in seen) and len(seen) == 5
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    rules = {r["doc_id"] for r in quality.ledger(table(spark, SF, "documents")).collect() if r["fail_bits"] == 0}
    assert set(inputs[1]) == rules
    text = lambda d: [(i, r["text"]) for i, r in sorted(d.items())]
    assert [(i, t) for i, _, _, t in deduplicated(text(inputs[1]))] == text(inputs[2])
    assert all(r["n_chars"] == len(r["text"]) for r in inputs[2].values())
    assert set(inputs[3]) == {i for i, _, c in linked(text(inputs[2])) if i == c}
    bad = {i for i, t in text(inputs[3]) for n, h, _ in [contaminated(t, items)] if h and 20 * h >= n}
    assert set(inputs[4]) == set(inputs[3]) - bad
    assert bad and decontamination.WINDOW == 13
    import zlib

    total = {i: packed([*ids_of(t), 1]) for i, t in text(inputs[4])}
    for r in last:
        ids = total[r["doc_id"]][4 * r["start"]:4 * (r["start"] + r["length"])]
        assert zlib.crc32(ids) == r["ids_crc32"] and r["doc_tokens"] == len(total[r["doc_id"]]) // 4
    assert sum(r["length"] for r in last) == sum(len(x) // 4 for x in total.values())


def test_nothing_else_imports_the_package():
    top = corpus_pipeline.__file__.rsplit("/", 1)[0]
    for folder, _, names in os.walk(f"{top}/candlewick"):
        if "/llm" not in folder:
            for n in (n for n in names if n.endswith(".py")):
                assert "llm" not in open(f"{folder}/{n}").read()
