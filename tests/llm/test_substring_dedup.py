import hashlib
import random
import re

import pytest

from sortproof.llm import substring_dedup
from sortproof.llm.substring_dedup import remove_duplicate_spans, substring_dedup_digest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=13):
    words = [WORD.findall(t or "") for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, words, strict=True):
        if i is None:
            continue
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            least[key] = min(least.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = set()
        for s in range(len(w) - window + 1):
            if i is not None and least[tuple(w[s : s + window])] < i:
                gone.update(range(s, s + window))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n=60, small=False):
    rng = random.Random(seed)
    vocabulary = ["a", "b"] if small else [f"w{i}é" for i in range(400)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(8, 60))] for _ in range(12)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += [rng.choice(vocabulary) for _ in range(rng.randint(0, 30))]
            p = rng.choice(passages)
            a = rng.randint(0, 5)
            w += p[a : len(p) - rng.randint(0, 5)]
        rows.append((i * 3 % 61, rng.choice([" ", "\n", "\t "]).join(w)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(docs_df, seed):
    rows = corpus(seed) + [(200, None), (201, ""), (202, "short text")]
    got = [tuple(r) for r in substring_dedup_digest(docs_df(rows).repartition(4)).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_across_chunks_and_with_few_words(docs_df, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 300)
    for rows in (corpus(3), corpus(4, n=30, small=True)):
        got = [tuple(r) for r in substring_dedup_digest(docs_df(rows).coalesce(1)).collect()]
        assert sorted(got, key=repr) == brute(rows)


def test_hot_passage_repeats_and_missing_ids(docs_df, clashing):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"own{i} {passage} end{i}") for i in range(80)]
    rows += [(5, rows[5][1]), (7, "another text of the same id " + passage), (None, passage), (None, "x " + passage), (-4, passage)]
    got = [tuple(r) for r in substring_dedup_digest(docs_df(rows, clashing).repartition(6)).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_spans_empty_table_and_long_text(docs_df):
    text = " ".join(str(i) for i in range(30_000))
    out = {r["doc_id"]: r for r in remove_duplicate_spans(docs_df([(1, text), (2, "a " + text + " b")]).select("doc_id", "text")).collect()}
    assert out[1]["n_removed"] == 0 and out[2]["kept"] == "a b"
    assert [(s["start"], s["length"]) for s in out[2]["spans"]] == [(1, 30_000)]
    assert substring_dedup_digest(docs_df([(1, "x")]).limit(0)).count() == 0
    with pytest.raises(ValueError, match="anchor"):
        substring_dedup.duplicate_places(docs_df([(1, "x")]), window=40, anchor=2)


def test_anchors_that_go_on_in_the_next_batch(docs_df, spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 200)  # settle little beforehand
    rows = corpus(5, n=50) + [(500 + i, f"x{i} " + " ".join(f"p{j}" for j in range(20))) for i in range(60)]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    for size in ("1", "7"):
        spark.conf.set(key, size)
        try:
            got = [tuple(r) for r in substring_dedup_digest(docs_df(rows).repartition(3)).collect()]
        finally:
            spark.conf.set(key, before)
        assert sorted(got, key=repr) == brute(rows)


def test_windows_of_a_frequent_anchor_part(docs_df, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(substring_dedup, "HOT_ROWS", 20)
    monkeypatch.setattr(substring_dedup, "SAMPLE", 1)
    rng = random.Random(8)
    phrase = " ".join(f"p{i}" for i in range(12))
    rows = [(i, " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(20)) + f" {phrase} n{i % 90} end end end") for i in range(150)]
    df = docs_df(rows).repartition(3)
    index = substring_dedup._indexed(df.select("doc_id", "text"), 13, 4).where("residues is not null")
    sizes = [r["n"] for r in index.groupBy("anchor").agg({"doc": "count"}).withColumnRenamed("count(doc)", "n").collect()]
    assert max(sizes) <= 20
    assert sorted((tuple(r) for r in substring_dedup_digest(df).collect()), key=repr) == brute(rows)
