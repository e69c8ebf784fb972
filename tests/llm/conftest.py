import os

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs_df(spark):
    """Documents from (id, text[, source]) tuples."""

    def make(rows, extra=None):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        return df if extra is None else df.selectExpr("*", *extra)

    return make


@pytest.fixture(scope="session")
def sf(spark):
    return "/root/testdata/sf0.001" if os.path.isdir("/root/testdata/sf0.001") else pytest.skip("no test data")


@pytest.fixture(scope="session")
def clashing():
    """Extra columns whose names the operators use or return themselves."""
    return [
        "1 as _id", "2 as _t", "3 as _key", "'x' as h", "4 as size", "5 as shard", "6 as n_words", "'k' as kept",
        "7 as score", "8 as ids", "9 as pos", "10 as `drop`", "11 as taken", "12 as label", "13 as n", "array(1) as bands",
    ]
