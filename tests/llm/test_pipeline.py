"""The pipeline on the small table, each stage against what it must do to its own input."""

import base64
import hashlib
import re
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from test_mixing import WORD, targets
from test_near_dup import brute_classes

ROOT = Path(__file__).resolve().parents[2]


def line_key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))


def test_stages_and_run(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    columns, inputs = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == columns, name
        inputs.append(docs.toPandas())
        docs = spark.createDataFrame(out.toPandas(), docs.schema)
    first, lines, near, mixed = inputs
    ids = lambda p: set(p.doc_id)
    # rules: labelled clean documents of 20 words stay, junk goes
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id").quality
    long = first[first.text.map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t)) >= 20)]
    good = [i for i in long.doc_id if labels.get(i) == 1]
    assert np.mean([i in ids(lines) for i in good]) > 0.97 and len(lines) < len(first)
    # line dedup: the texts that counting by hand leaves
    counts = Counter()
    for t in lines.text:
        counts.update({line_key(x) for x in t.split("\n")} - {""})
    for r in lines.itertuples():
        kept = [x for x in r.text.split("\n") if counts[line_key(x)] < 10]
        assert near.set_index("doc_id").text[r.doc_id] == "\n".join(kept)
    # near-duplicates: the least id of every class of all pairs
    rows = list(near[["doc_id", "text"]].itertuples(index=False, name=None))
    assert ids(mixed) == {c[0] for c in brute_classes(rows)}
    assert set(mixed.text) <= set(near.text)
    # mixing: every source near its target, documents unchanged, three times at most
    out = docs.toPandas()
    words = lambda t: len(WORD.findall(t))
    sizes = mixed.text.map(words).groupby(mixed.source).sum().to_dict()
    want, longest = targets(sizes), mixed.text.map(words).max()
    got = out.text.map(words).groupby(out.source).sum().to_dict()
    assert all(abs(got.get(s, 0) - want[s]) <= longest for s in sizes)
    assert out.groupby("doc_id").size().max() <= 3 and set(out.text) <= set(mixed.text)
    # the last stage: tokens of every row
    rows = docs.toPandas()
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf).toPandas()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(corpus_pipeline.VOCABULARY, "rb"))}
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    def want(r):
        ids = library.encode_ordinary(r.text)
        return r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()
    assert sorted(map(tuple, out.itertuples(index=False))) == sorted(want(r) for r in rows.itertuples())
    # run() does the same
    whole = corpus_pipeline.run(spark, sf).toPandas()
    assert sorted(map(tuple, whole.itertuples(index=False))) == sorted(map(tuple, out.itertuples(index=False)))


def test_the_rest_works_without_the_subpackage(tmp_path):
    for part in ("__spark_entry__.py", "sortproof"):
        subprocess.run(["cp", "-r", str(ROOT / part), str(tmp_path)], check=True)
    (tmp_path / "sortproof/llm").rename(tmp_path / "gone")
    code = "import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op') for k in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert out.stdout.split()[1] == "False" and int(out.stdout.split()[0]) > 30


def test_every_stage_takes_odd_rows_and_empty_tables(spark, docs_df, clashing):
    prose = " ".join(f"w{i % 37}x{i}" for i in range(60))
    rows = [(1, prose, "a"), (1, prose, "a"), (2, None, None), (None, prose + " end", "b"), (None, None, None), (3, "", "a"), (4, "word " * 20_000, "b")]
    odd = docs_df(rows, clashing)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, "")
        assert name == "byte_bpe" or out.columns == odd.columns
        kept = Counter(r["doc_id"] for r in out.collect())
        want = {
            "quality_rules": {1: 2, None: 1}, "line_dedup": {1: 2, 2: 1, None: 2, 3: 1, 4: 1}, "near_dup": {1: 1, 2: 1, 4: 1},
            "byte_bpe": {1: 2, 2: 1, None: 2, 3: 1, 4: 1},
        }.get(name)
        assert want is None or kept == want, name
        if name == "mixing":  # texts without words stay, the long one is over its share of 2 in 1 + 2 + 3
            assert kept[3] == 1 and kept[2] == 1 and kept[4] <= 3
        nothing = stage(spark, odd.limit(0), "")
        assert nothing.count() == 0 and (name == "byte_bpe" or nothing.columns == odd.columns)
