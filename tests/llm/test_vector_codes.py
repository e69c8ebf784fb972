"""Vector codes against plain integer loops, and tries against full distance tables."""

import hashlib
import math

import numpy as np
import pytest

from sortproof.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, entries=V.ENTRIES, rounds=V.ROUNDS):
    """{dimension: sha256}, rows (vec_id, code, error, label_error), in plain Python; rows: (vec_id, vector, label)."""
    kept = []
    for vec_id, vector, label in rows:
        if vector is None or not vector or len(vector) % 4 or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(1024 * float(np.float32(x))) for x in vector]
        if max(map(abs, whole)) <= V.largest(len(whole)):
            kept.append((vec_id, whole, label))
    shas, out = {}, []
    for dim in {len(v) for _, v, _ in kept}:
        own = [(i, v, x) for i, v, x in kept if len(v) == dim]
        w = dim // 4
        first = {}
        for i, v, _ in own:
            if i is not None:
                first[i] = min(v, first.get(i, v))
        heads = [first[i] for i in sorted(first)[:entries]] or [[0] * dim]
        books = [[v[j * w : (j + 1) * w] for v in heads] for j in range(4)]

        def nearest(x, book):
            return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

        for _ in range(rounds):
            for j, book in enumerate(books):
                members = {}
                for _, v, _ in own:
                    x = v[j * w : (j + 1) * w]
                    members.setdefault(nearest(x, book)[1], []).append(x)
                for k, xs in members.items():
                    book[k] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
        shas[dim] = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
        for i, v, label in own:
            got = [nearest(v[j * w : (j + 1) * w], books[j]) for j in range(4)]
            out.append((i, "".join(f"{k:02x}" for _, k in got), sum(d for d, _ in got), label, shas[dim]))
    total = {}
    for r in out:
        total[r[3]] = total.get(r[3], 0) + r[2]
    return sorted(((i, c, e, total[x], s) for i, c, e, x, s in out), key=str)


def result(df):
    return sorted(map(tuple, V.vector_codes_digest(df).collect()), key=str)


@pytest.mark.parametrize("width, spread, leaves", [(1, 3, 4), (4, 2, 7), (5, 40, 3), (16, 500, 512), (3, 1, 1)])
def test_walk_equals_full_distances(width, spread, leaves):
    rng = np.random.default_rng(width)
    parts, _ = V.distinct_rows(rng.integers(-spread, spread + 1, (400, width)))
    book = rng.integers(-spread, spread + 1, (37, width))
    full = ((parts[:, None] - book[None]) ** 2).sum(2)
    code, error = V.nearest_entries(parts, book, leaves)
    assert code.tolist() == full.argmin(1).tolist() and error.tolist() == full.min(1).tolist()


def test_distinct_rows_are_in_order():
    rows = np.random.default_rng(0).integers(-2, 3, (300, 3))
    own, place = V.distinct_rows(rows)
    assert own.tolist() == sorted({tuple(r) for r in rows.tolist()} and [list(t) for t in {tuple(r) for r in rows.tolist()}])
    assert (own[place] == rows).all()
    assert V.nearest_entries(np.zeros((0, 4), np.int64), np.zeros((3, 4), np.int64))[0].tolist() == []


def test_equals_plain_loops(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(0, 0.2, 8).astype(np.float32).tolist(), int(i) % 3 if i % 5 else None) for i in rng.permutation(150)]
    rows += [(3, rows[0][1], 1)] * 40  # a hot vector, a repeated id
    monkeypatch.setattr(V, "ENTRIES", 20)
    monkeypatch.setattr(V.train_codebooks, "__defaults__", (20, V.ROUNDS))
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows, 20)


def test_odd_rows(spark, clashing):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, -0.5, 0.25, 0.0], 1), (1, [0.5, -0.5, 0.25, -0.25], 1), (None, [0.1, 0.2, 0.3, 0.4], None), (2, None, 1), (3, [], 1),
        (4, [nan, 0.0, 0.0, 0.0], 1), (5, [0.0, inf, 0.0, 0.0], 1), (6, [0.0, 0.0, 0.0], 1), (7, [0.0, None, 0.0, 0.0], 1),
        (8, [1e30, 0.0, 0.0, 0.0], 1), (9, [0.0] * 8, None), (-5, [-0.0001, 1e6, -1e6, 0.0], 2), (9, [0.0] * 8, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", *[c for c in clashing if not c.endswith(" label")], "1 as dim", "2 as v", "3 as code", "4 as part")
    assert result(df) == brute(rows)


def test_no_ids_at_all(spark):
    rows = [(None, [0.5, -0.5, 0.25, 0.0], 1), (None, [0.1, 0.5, 0.25, 0.0], 1)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_empty_table(spark):
    out = V.vector_codes_digest(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0
    assert dict(out.dtypes) == {"vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"}
