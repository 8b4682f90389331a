"""Every registered query against its DuckDB oracle (the driver's gate), at sf0.001."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))
import __spark_entry__ as entry  # noqa: E402
from candlewick.plans import registry  # noqa: E402
from oracle_check import TABLES, rows_of, type_problems  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(registry.ORACLES) == set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["date", "symbol", "open_price", "high_price", "low_price",
                          "close_price", "volume", "number_of_trades"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got, cols = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(entry.oracle_sql()[name])
    assert not type_problems(df, res)
    ocols = [d[0] for d in res.description]
    exp = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(got) == len(exp)
    assert rows_of(got, cols) == rows_of(exp, ocols)
