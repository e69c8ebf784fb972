import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from sortproof.llm import near_dup
from sortproof.llm.components import components
from sortproof.llm.near_dup import drop_near_duplicates, near_dup_digest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_counts(text):
    w = WORD.findall(text or "")
    if not w:
        return Counter()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute_classes(rows, similarity=0.8):
    """Least id of each row's class, by all pairs and exact document frequencies."""
    sets = [shingle_counts(t) for _, t in rows]
    n = max(1, sum(1 for s in sets if s))
    df = Counter(k for s in sets for k in s)
    least = 1 / near_dup.WIDTH
    idf = {k: 1 + near_dup.IDF_SPAN * math.log(max(least, min(1, c / n))) / math.log(least) for k, c in df.items()}
    total = [sum(c * idf[k] for k, c in s.items()) for s in sets]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = sum(min(c, sets[j][k]) * idf[k] for k, c in sets[i].items() if k in sets[j])
            union = total[i] + total[j] - shared
            if (rows[i][1] or "") == (rows[j][1] or "") or (union and shared / union >= similarity):
                parent[root(i)] = root(j)
    classes = defaultdict(list)
    for i in range(len(rows)):
        classes[root(i)].append(i)
    out = [None] * len(rows)
    for members in classes.values():
        for i in members:
            out[i] = (min((rows[m][0] for m in members if rows[m][0] is not None), default=None), len(members))
    return out


def corpus(seed=5):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    rows, i = [], 0
    for group in (1, 1, 1, 2, 3, 5, 40):
        base = [rng.choice(words) for _ in range(rng.randint(60, 200))]
        made = [base]
        for _ in range(group - 1):
            copy = list(rng.choice(made))  # a tree of changed copies
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            made.append(copy)
        for w in made:
            rows.append((i * 7 % 101, " ".join(w)))
            i += 1
    return rows


def check(docs_df, rows, extra=None):
    df = docs_df(rows, extra).repartition(5)
    got = Counter((r["doc_id"], r["class_id"], r["class_size"]) for r in near_dup_digest(df).collect())
    assert got == Counter((r[0], *c) for r, c in zip(rows, brute_classes(rows), strict=True))
    return df


def test_classes_against_all_pairs(docs_df):
    check(docs_df, corpus())


def test_odd_texts_ids_and_columns(docs_df, clashing):
    rows = corpus(6)[:20]
    rows += [(200, None), (201, ""), (202, "two words"), (203, "two  words"), (204, "two"), rows[0], (None, rows[0][1]), (None, "only here " * 4)]
    df = check(docs_df, rows, clashing)
    out = drop_near_duplicates(df)
    assert out.columns == df.columns
    assert len({c for c in brute_classes(rows)}) <= out.count() == len(set(brute_class_keys(rows)))


def brute_class_keys(rows):
    plain = [(k, t) for k, (_, t) in enumerate(rows)]
    return [c[0] for c in brute_classes(plain)]


def test_open_buckets_find_links_that_leaders_miss(docs_df, monkeypatch):
    monkeypatch.setattr(near_dup, "LEADERS", 0)  # nothing but the second look
    monkeypatch.setattr(near_dup, "TILE_MEMBERS", 8)
    monkeypatch.setattr(near_dup, "TILE_SHINGLES", 600)
    monkeypatch.setattr(near_dup, "OPEN_SHINGLES", 700)
    check(docs_df, corpus(7))


def test_empty_table(docs_df):
    empty = docs_df([(1, "x")]).limit(0)
    assert near_dup_digest(empty).count() == 0 and drop_near_duplicates(empty).count() == 0


def test_samples_agree_as_often_as_weighted_sets_do():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 63, 400, np.uint64)
    table = near_dup.draw_table()
    a, b = np.sort(values[:300]), np.sort(values[60:])
    wa, wb = np.full(300, 1.1), np.full(340, 1.1**3)
    both = np.isin(a, b)
    want = (both.sum() * 1.1) / (wa.sum() + wb.sum() - both.sum() * 1.1)
    _, sa = near_dup.samples(np.zeros(300, int), a, wa, table)
    _, sb = near_dup.samples(np.zeros(340, int), b, wb, table)
    assert (sa == sb).mean() == pytest.approx(want, abs=0.14)


@pytest.mark.parametrize(("single", "heavy", "times"), [(100_000, 100, 200), (16_000, 20, 180), (800, 10, 20), (30, 1, 8)])
def test_samples_of_long_texts_with_a_repeated_passage(single, heavy, times):
    rng = np.random.default_rng(single)
    table, agree = near_dup.draw_table(), []
    for _ in range(4):
        values = rng.integers(0, 1 << 63, single + heavy, np.uint64) * np.uint64(2) + rng.integers(0, 2, single + heavy, np.uint64)
        weights = np.append(np.full(single, 1.15), np.full(heavy, 1.15 * times))
        both = np.append(values, values[:single])
        row = np.append(np.zeros(len(values), int), np.ones(single, int))
        _, drawn = near_dup.samples(row, both, np.append(weights, weights[:single]), table)
        agree.append((drawn[0] == drawn[1]).mean())
    assert np.mean(agree) == pytest.approx(single / (single + heavy * times), abs=0.07)


def test_samples_by_weight_and_without_a_likely_shingle(monkeypatch):
    rng = np.random.default_rng(3)
    values, weights = rng.integers(0, 1 << 63, 500, np.uint64), rng.choice([1.0, 1.2, 7.0, 300.0], 500)
    row, table = np.sort(rng.integers(0, 20, 500)), near_dup.draw_table()
    want = near_dup.samples(row, values, weights, table)[1]
    for likely in (0.01, 60.0):
        monkeypatch.setattr(near_dup, "LIKELY", likely)
        assert (near_dup.samples(row, values, weights, table)[1] == want).all()


def test_shingles_and_sketch(spark):
    row, values, counts = near_dup.shingles(pa.array(["a b c d e f", None, "x y", "a b c d e a b c d e"]))
    assert Counter(row.tolist()) == {0: 2, 2: 1, 3: 5} and counts.sum() == 2 + 1 + 6
    assert len(set(values[row == 0].tolist()) & set(values[row == 3].tolist())) == 1
    texts = spark.createDataFrame([(f"a b c d e {i} {i} {i} {i} {i}",) for i in range(90)], "t string").repartition(70)
    weights = near_dup.document_frequencies(texts, "t")
    assert weights.documents == 90
    _, v, c = near_dup.shingles(pa.array(["a b c d e"]))
    assert weights(v, c)[0] == pytest.approx(1.0)


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 470)]
    parent = {x: x for e in links for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = sorted((root(a), root(b)))
        parent[rb] = ra
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}
