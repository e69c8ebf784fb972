"""Source divergence audit against plain loops over all groups and terms."""

import re
from collections import Counter

import numpy as np
import pytest

from sortproof.llm import divergence_audit as A

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = {i: i + 32 for i in range(65, 91)}


def brute(rows, min_documents, top):
    """rows: (text, lang, source)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    counts, docs, groups = Counter(), Counter(), set()
    for text, lang, source in rows:
        groups.add((lang, source))
        found = [t.translate(FOLD) for t in TERM.findall(text)]
        counts.update((lang, source, t) for t in found)
        docs.update((lang, t) for t in set(found))
    out = []

    def share(n, total):
        return 1 + 10**9 * (n + 2) // total

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    for lang in {g[0] for g in groups}:
        sources = sorted((s for x, s in groups if x == lang), key=str.encode)
        kept = [t for (x, t), d in docs.items() if x == lang and d >= min_documents]
        total = {s: sum(counts[lang, s, t] for t in kept) + 2 * len(kept) for s in sources}
        whole = sum(total.values()) - 2 * len(kept) * (len(sources) - 1)
        p = {(s, t): share(counts[lang, s, t], total[s]) for s in sources for t in kept}
        q = {t: share(sum(counts[lang, s, t] for s in sources), whole) for t in kept}
        for s in sources:
            pairs = [(sum(f(p[s, t], p[o, t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(p[s, t], q[t]), t) for t in kept if counts[lang, s, t] and p[s, t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, r) for r, (v, i) in enumerate(items, 1) if part == "pair" or r <= top]
    return sorted(out)


ODD = [
    (None, None, None), ("", "en", "a"), ("The the THE cat", "en", "a"), ("the dog", "en", "b"), ("the dog", "en", "b"),
    ("Éa éa ÀB_ab[ab]ab`ab{ab}x9y the cat", "en", "c"), ("the cat\x00cat cat", "en", None), ("日本 日本の the", "en", "ü"),
    ("solo", "xx", "only"), ("!!! 123", "yy", "a"), ("!!! 123", "yy", "b"), ("the " * 3000 + "Dog", "en", "\U00010000"),
    ("le chat", "fr", "a"), ("le chien le", "fr", "b"), ("le chat noir", "fr", "c"),
]


def frame(spark, rows, extra=()):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", *extra)


@pytest.mark.parametrize("min_documents, top", [(1, 10), (2, 1), (50, 10)])
def test_equals_plain_loops(spark, clashing, min_documents, top):
    df = frame(spark, ODD, [*clashing, "'z' as term", "1 as p", "2 as block", "3 as value"]).repartition(3)
    got = sorted(map(tuple, A.divergence_audit(df, min_documents, top).collect()))
    assert got == brute(ODD, min_documents, top)


def test_blocks_and_strides_do_not_change_the_result(spark, monkeypatch):
    rng = np.random.default_rng(5)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    rows = [(" ".join(rng.choice(words, 40)), "en", f"s{i % 17}") for i in range(200)]
    want = brute(rows, 3, 10)
    monkeypatch.setattr(A, "BLOCK_POSTINGS", 50)
    monkeypatch.setattr(A, "TASK_PAIRS", 60)
    got = sorted(map(tuple, A.divergence_audit(frame(spark, rows), 3).collect()))
    assert got == want


def test_empty_table(spark):
    out = A.divergence_audit(frame(spark, []))
    assert out.count() == 0 and out.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_counts_beyond_a_long_when_scaled(spark):
    big = spark.createDataFrame([(30_000_000_000, 90_000_000_003)], "n long, total long")
    assert big.select(A._share("n", "total")).first()[0] == 1 + 10**9 * (30_000_000_000 + 2) // 90_000_000_003


def test_one_row_takes_no_pairs_of_postings():
    # three groups, two terms: by hand
    term, group, share = np.array([0, 0, 1]), np.array([0, 1, 2]), np.array([50, 30, 70])
    zero = np.array([2, 3, 4])
    got = list(A.accumulated(term, group, share, zero, np.arange(3)))
    full = np.array([[50, 2], [30, 3], [4, 70]])
    want = [[sum(int((a - b) ** 2 // (a + b)) for a, b in zip(x, y, strict=True)) for y in full] for x in full]
    assert [r.tolist() for r in got] == want
