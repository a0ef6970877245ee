"""The driver contract: entry, queries, oracles (DuckDB) at the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "part orders lineitem events embeddings documents pages labels".split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["movieId", "title", "rating_count", "avg_rating"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(rows):
    return sorted(tuple("nan" if isinstance(x, float) and math.isnan(x) else
                        (round(x, 9) if isinstance(x, float) else x) for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle_agrees(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rel = duck.sql(E.oracle_sql()[name])
    assert df.columns == rel.columns
    assert _norm(tuple(r) for r in df.collect()) == _norm(rel.fetchall())
