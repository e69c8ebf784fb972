import random
import re

import numpy as np

from sortproof.llm.site_quality import classify_quality, held_out, site_of, site_quality_digest
from pyspark.sql import functions as F


def prose(rng, n):
    return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(n))


def tables(spark, docs_df, n=400):
    rng = random.Random(4)
    rows, labels, pages = [], [], []
    for i in range(n):
        good = i % 4 != 0
        text = prose(rng, rng.randint(25, 120))
        rows.append((i, text if good else text.replace(" ", "### ").upper(), f"s{i % 3}"))
        labels.append((i, int(good), 0))
        if i % 5 == 0:
            pages.append((i, f"https://www.Host{i % 2}.example/en/{i}", ""))
    return (
        rows, docs_df(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        spark.createDataFrame(pages, "page_id long, url string, html string"),
    )


def test_held_out_accuracy(spark, docs_df):
    rows, docs, labels, pages = tables(spark, docs_df)
    out = site_quality_digest(docs, labels, pages).collect()
    assert len(out) == len(rows)
    test = [r for r in out if r["held_out"]]
    assert len(test) > 80 and np.mean([r["kept"] == (r["doc_id"] % 4 != 0) for r in test]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in out)


def test_sparse_sites_are_drawn_to_their_parents(spark, docs_df):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(600):  # hosts of very different rates
        host = i % 6
        good = rng.random() < (0.95 if host < 3 else 0.3)
        text = prose(rng, 60)
        rows.append((i, text if good else re.sub(r"(\w+)", r"\1***", text), f"h{host}"))
        labels.append((i, int(good), 0))
    rows.append((9999, re.sub(r"(\w+)", r"\1***", prose(rng, 60)), "lonely"))
    rows.append((9998, prose(rng, 60), "lonely too"))
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([], "doc_id long, url string")
    out = {r["doc_id"]: r for r in classify_quality(docs_df(rows), labels, pages).collect()}
    assert out[0]["host_rate"] > 0.85 and out[5]["host_rate"] < 0.45
    # one document barely moves a host of its own from the global rate, hundreds do
    assert abs(out[9999]["host_rate"] - out[9998]["host_rate"]) < abs(out[0]["host_rate"] - out[5]["host_rate"])
    assert out[5]["host_rate"] < out[9999]["host_rate"] < out[9998]["host_rate"] < out[0]["host_rate"]


def test_odd_rows_and_empty_tables(spark, docs_df, clashing):
    rows, docs, labels, pages = tables(spark, docs_df, 60)
    odd = rows + [(None, "x"), (700, None, None), (701, ""), rows[1], (702, "word " * 20_000)]
    labels = labels.unionByName(spark.createDataFrame([(None, 1, 0), (1, None, 0), (2, 0, 0)], labels.schema))
    pages = pages.unionByName(spark.createDataFrame([(None, None, None), (1, "no address", ""), (2, "http://x.example/en/3", "")], pages.schema))
    out = site_quality_digest(docs_df(odd, clashing), labels, pages).collect()
    assert len(out) == len(odd) and all(0 <= r["score"] <= 1 for r in out)
    assert site_quality_digest(docs.limit(0), labels, pages).count() == 0
    assert {r["kept"] for r in site_quality_digest(docs, labels.limit(0), pages.limit(0)).collect()} <= {True, False}


def test_sites_of_addresses_and_folds(spark):
    host, path = site_of(F.lit("https://www.A.example/en/5?x"))
    r = spark.range(1).select(host.alias("h"), path.alias("p"), held_out(F.lit(None).cast("long")).alias("o")).first()
    assert tuple(r) == ("a.example", "a.example/en", False)
