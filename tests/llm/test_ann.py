import numpy as np
import pyarrow as pa
import pytest

from sortproof.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n, d=64, seed=0, ids=None):
    x = np.random.default_rng(seed).normal(size=(n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(int(i), [float(np.float32(v)) for v in r], 0) for i, r in zip(ids if ids is not None else range(n), x, strict=True)]


def brute(rows, k=10):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float64)
    out = {}
    for q, v in zip(ids, x, strict=True):
        if q % 100 == 0:
            d = np.sqrt(((x - v) ** 2).sum(1))
            d[ids == q] = np.inf
            order = [i for i in np.lexsort((ids, d)) if np.isfinite(d[i])][:k]
            out[int(q)] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        got = out.setdefault(r["query_id"], [])
        got.append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got)
    return out


def test_recall_and_exact_scores(spark):
    rows = vectors(3000)
    got, want = found(ann.ann_digest(spark.createDataFrame(rows, SCHEMA))), brute(rows)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    exact = {q: dict(zip([r[0] for r in rows], np.sqrt(((np.array([r[1] for r in rows]) - np.array(rows[q][1])) ** 2).sum(1)), strict=True)) for q in want}
    for q, pairs in got.items():
        assert all(s == exact[q][i] for i, s in pairs) and pairs == sorted(pairs, key=lambda p: (p[1], p[0]))


def test_few_candidates_all_come(spark):
    rows = vectors(6, ids=[0, 1, 2, 100, 4, 5])
    assert found(ann.ann_digest(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_ties_copies_and_a_hot_bucket(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 50)
    rows = vectors(40, d=8, seed=3) + [(1000 + i, vectors(1, d=8, seed=9)[0][1], 1) for i in range(300)]
    got = found(ann.ann_digest(spark.createDataFrame(rows, SCHEMA).repartition(4)))
    # the query 1000 is one of 300 equal vectors: distance 0, smallest ids first
    assert got[1000] == [(1001 + i, 0.0) for i in range(10)]


def test_ids_repeated_many_times_count_once(spark):
    rows = vectors(300, d=16, seed=11)
    # every id with other vectors too, and the query's nearest ids thirty times
    near = [i for i, _ in brute(rows, 12)[100]]
    df = rows + vectors(300, d=16, seed=12) + [rows[i] for i in near for _ in range(29)]
    got = found(ann.ann_digest(spark.createDataFrame(df, SCHEMA)))
    at = {r[0]: np.array(r[1]) for r in rows}
    other = {r[0]: np.array(r[1]) for r in df[300:600]}
    least = {i: min(np.sqrt(((v - at[100]) ** 2).sum()) for v in (at[i], other[i])) for i in at if i != 100}
    index, query = pa.table({"id": [r[0] for r in df], "v": [np.array(r[1]).tobytes() for r in df]}), at[100].tobytes()
    best = ann._best(index, pa.table({"id": [100], "v": [query]}), 10).to_pydict()
    want = sorted(least, key=lambda i: (least[i], i))[:10]
    assert best["vec_id"] == want and best["score"] == [least[i] for i in want]
    assert all(len({i for i, _ in pairs}) == 10 for pairs in got.values())


def test_rows_that_take_no_part(spark):
    rows = vectors(200, d=16, seed=5)
    odd = [
        (300, None, 0), (301, [], 0), (302, [0.0] * 16, 0), (400, [float("nan")] * 16, 0), (303, [1.0] * 15 + [float("inf")], 0),
        (None, rows[1][1], 0), (304, [1.0] * 15 + [None], 0), (500, [1.0, 2.0], 0), (rows[7][0], rows[7][1], 0),
    ]
    df = spark.createDataFrame(rows + odd, SCHEMA).selectExpr("*", "1 as t", "2 as id", "3 as rank", "4 as v", "5 as dim")
    got = found(ann.ann_digest(df))
    assert set(got) == {0, 100}  # 500 has no candidate of its dimension
    for pairs in got.values():
        ids = [i for i, _ in pairs]
        assert len(set(ids)) == 10 and not set(ids) & {300, 301, 302, 303, 304, 400, 500}


def test_empty_table_and_rotation(spark):
    assert ann.ann_digest(spark.createDataFrame([], SCHEMA)).count() == 0
    x = np.eye(6)
    y = ann.rotate(x, 1)
    assert y.shape == (6, 8) and y @ y.T == pytest.approx(np.eye(6))
    assert (ann.signed_axes(np.array([[0.1, -0.9, 0.4]]), 6) == [[3, 4, 0, 1, 5, 2]]).all()
