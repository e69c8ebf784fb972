import re

import pytest

from sortproof.llm.mixing import mix, mixed_documents, mixing_digest


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, max_epochs=3.0):
    """Reshare by weight until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > max_epochs * sizes[s]}
        if not full:
            target.update({s: level * weight[s] for s in open_})
            break
        for s in full:
            target[s] = max_epochs * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def check(rows, out):
    sizes, source = {}, {}
    for i, t, s in rows:
        n = len(WORD.findall(t or ""))
        sizes[s] = sizes.get(s, 0) + n
        source[i] = (s, n)
    want = targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    assert len(out) == len(rows)
    for r in out:
        s, n = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (n, sizes[s])
        assert r["target"] == pytest.approx(want[s], rel=1e-9, abs=1e-9)
        assert 0 <= r["taken"] <= 3 * n
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6


def test_budgets_are_cut_exactly(docs_df, clashing):
    rows, i = [], 0
    for s, n in (("a", 400), ("b", 20), ("B", 5), ("ü", 60), ("z", 1), (None, 3)):
        for k in range(n):
            rows.append((i, " ".join(["w"] * (k % 7)), s))
            i += 1
    rows += [(i, None, "a"), (i + 1, "", "only empty"), (i + 2, "x " * 900, "z")]
    df = docs_df(rows, clashing)
    one, two = mixing_digest(df).collect(), mixing_digest(df.repartition(5)).collect()
    check(rows, one)
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))  # reruns agree


def test_hot_source_spreads_over_ranges(docs_df):
    rows = [(i, "one two three", "hot") for i in range(300)] + [(i, "x", f"s{i}") for i in range(300, 330)]
    check(rows, mix(docs_df(rows).select("doc_id", "text", "source"), ranges=16).collect())


def test_documents_as_often_as_taken(docs_df, clashing):
    rows = [(i, "a b c", "big") for i in range(60)] + [(100, "x y", "small"), (101, None, "small"), (None, "q r", "small")]
    df = docs_df(rows, clashing)
    out = mixed_documents(df)
    assert out.columns == df.columns
    n = {}
    for r in out.collect():
        n[r["doc_id"]] = n.get(r["doc_id"], 0) + 1
    # small (weight 2) may be taken three times at most
    assert n[100] == 3 and n[None] == 3 and n[101] == 1
    assert 56 <= sum(v for k, v in n.items() if k is not None and k < 60) <= 60


def test_empty_tables(docs_df):
    assert mixing_digest(docs_df([(1, "x")]).limit(0)).count() == 0
    out = mixing_digest(docs_df([(1, None), (2, " ")])).collect()
    assert [(r["target"], r["taken"]) for r in out] == [(0.0, 0)] * 2


def test_repeated_rows_each_count(docs_df):
    rows = [(1, "a b", "s")] * 4 + [(2, "c", "t")]
    out = mixing_digest(docs_df(rows)).collect()
    assert len(out) == 5
    assert sum(r["taken"] for r in out) == sum(round(t) for t in {r["source_size"]: r["target"] for r in out}.values())


def test_repeated_rows_at_the_cut(docs_df):
    """100 equal rows of ten words with a budget of 600: sixty of them, not all."""
    text = " ".join(["w"] * 10)
    rows = [(1, text, "a")] * 100 + [(2, text, "b")] * 40 + [(3, "x y", "b")] * 200
    sizes = {"a": 1000, "b": 800}
    out = mixed_documents(docs_df(rows)).collect()
    want = targets(sizes)
    for s in sizes:
        words = sum(len(r["text"].split()) for r in out if r["source"] == s)
        assert want[s] - 0.5 <= words < want[s] + 10.5
    # equal ids and texts in two sources are two documents
    twice = [(1, "a b c", "p")] * 6 + [(1, "a b c", "q")] * 2 + [(None, "a b", None)] * 3
    out = mixed_documents(docs_df(twice)).collect()
    assert {r["source"] for r in out} == {"p", "q", None} and all((r["source"] is None) == (r["doc_id"] is None) for r in out)
