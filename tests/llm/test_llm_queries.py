"""Queries with SQL against DuckDB, and every query's shape, on the small tables."""

import duckdb
import pytest

import __spark_entry__ as E
from sortproof.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = QUERIES[name](spark, sf)
    cur = con.execute(ORACLE[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(cur.fetchall())


def test_ten_queries_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert set(ORACLE) <= set(E.oracle_sql())
