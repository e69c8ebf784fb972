"""Every registered query against its DuckDB oracle (sf0.001)."""

import hashlib
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from sortproof.plans.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def _norm(v):
    if v is None or (isinstance(v, float) and pd.isna(v)):
        return "NULL"
    if hasattr(v, "item"):
        v = v.item()
    return str(v).lower() if isinstance(v, bool) else str(v)


def digest(df):
    cols = sorted(df.columns)
    rows = sorted("|".join(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got_t = E.queries()[name](spark, SF).toArrow()
    want_t = con.sql(E.oracle_sql()[name]).to_arrow_table()
    # same column names and Arrow types, same rows (order-insensitive)
    assert {f.name: str(f.type) for f in got_t.schema} == {f.name: str(f.type) for f in want_t.schema}
    got, want = got_t.to_pandas(), want_t.to_pandas()
    assert len(got) == len(want)
    assert digest(got) == digest(want)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "pos" in df.columns
    assert os.path.exists(SF)
