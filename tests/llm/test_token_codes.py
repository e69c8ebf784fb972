"""Token files: codes, random access, and whole texts against the tokenizers library."""

import glob
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sortproof.llm import token_codes as C
from sortproof.llm.queries import op12_token_codes

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    (7, "Hello world, it's  a test\n\tThe end"), (None, "no id"), (3, None), (3, ""), (5, "   \n "), (-4, "é ́x ΣΑΣ İ ß y z"),
    (9, "日本語 text <|endoftext|> <|startoftext|>"), (9, "a\x0bb\x0cc\x85d\r\ne"), (2**62, "x" * 5000), (11, "word " * 4000),
    (12, "same"), (12, "same"), (12, "other"), (13, "\x00 \x1f\U0001f600﻿"), (14, "don't WE'LL 123 45.6"),
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def frame(spark, rows, extra=()):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *extra)


def expected(rows, library):
    """(doc_id, ids) in the order of the files, but for the order of equal ids."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    return [(i, [*library(t), C.END_ID]) for i, t in rows]


# -- codes ---------------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 255, 256, 65535, 65536, 2**24, 2**32 - 1]) | st.integers(0, 2**32 - 1), max_size=1500))
def test_levels_give_back_any_token(ids):
    own = np.array(ids, np.uint32)
    docs = pa.array([5], pa.int64())
    raw = C.file_bytes(1, 2, docs, np.array([len(own)]), own) + b"\n"
    file = C.TokenFile.of(raw)
    assert (file.range, file.part, file.documents, file.tokens) == (1, 2, 1, len(own))
    assert file.read(0, len(own)).tolist() == ids and file.document(0).tolist() == ids
    for i in range(0, len(ids), 1 + len(ids) // 20):
        assert file.token(i) == ids[i]
        assert file.read(i, min(len(ids), i + 700)).tolist() == ids[i : i + 700]


def test_damage_is_found():
    raw = bytearray(C.file_bytes(0, 0, pa.array([1], pa.int64()), np.array([3]), np.array([1, 300, 70000])) + b"\n")
    raw[-8] ^= 1
    with pytest.raises(ValueError):
        C.TokenFile.of(bytes(raw))
    with pytest.raises(ValueError):
        C.TokenFile.of(b"x" * 200)


def test_a_token_is_read_without_its_block():
    ids = np.random.default_rng(1).integers(0, 49_408, 400_000)
    raw = C.file_bytes(0, 0, pa.array([1, None], pa.int64()), np.array([399_000, 1000]), ids) + b"\n"
    read = []

    def fetch(at, size):
        read.append(size)
        return raw[at : at + size]

    file = C.TokenFile(fetch)
    for i in (0, 123_456, 399_999):
        read.clear()
        assert file.token(i) == ids[i] and sum(read) < 200
    read.clear()
    assert file.document(1).tolist() == ids[399_000:].tolist() and sum(read) < 5000
    assert file.document_ids().to_pylist() == [1, None]


# -- encoding ------------------------------------------------------------------

@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAzẹ́́ \n\t\x0b\x85 'sST1²,.<|>Σς각\U0001f600"), max_size=40), max_size=5))
def test_words_encode_like_whole_texts(texts):
    t = Tokenizer.from_file(VOCABULARY) if not hasattr(test_words_encode_like_whole_texts, "t") else test_words_encode_like_whole_texts.t
    t.encode_special_tokens = True
    test_words_encode_like_whole_texts.t = t
    own = C.WordEncoder(VOCABULARY) if not hasattr(t, "own") else t.own
    ids, counts = own(pa.array(texts, pa.string()))
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_forgetting_words_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(C, "KEPT_WORDS", 3)
    own = C.WordEncoder(VOCABULARY)
    for text in ("one two three four five", "six one seven two", "one", "We'll SEE: 12,5 (ok)'tis don't's"):
        assert own(pa.array([text]))[0].tolist() == library(text) == own.whole(pa.array([text]))[0].tolist()


# -- files ---------------------------------------------------------------------

@pytest.mark.parametrize("file_tokens", [1, 3000, C.FILE_TOKENS])
def test_files_give_back_whole_texts(spark, tmp_path, library, clashing, file_tokens):
    path = f"{tmp_path}/tokens"
    df = frame(spark, ODD, [*clashing, "1 as first", "2 as start", "3 as file", "4 as _text"]).repartition(4)
    C.write_token_files(df, path, VOCABULARY, file_tokens=file_tokens)
    got = C.read_token_files(spark, path).orderBy("start").collect()
    want = expected(ODD, library)
    assert [r["doc_id"] for r in got] == [i for i, _ in want]
    ids = [np.frombuffer(r["ids"], "<u4").tolist() for r in got]
    assert sorted(map(str, zip([r["doc_id"] for r in got], ids, strict=True))) == sorted(map(str, want))
    assert [r["start"] for r in got] == np.append(0, np.cumsum([len(x) for x in ids]))[:-1].tolist()
    assert [r["n_tokens"] for r in got] == [len(x) for x in ids]
    # any document through its file alone
    files = [C.TokenFile.open(f) for f in glob.glob(f"{path}/part-*")]
    files.sort(key=lambda f: (f.range, f.part))
    assert [f.document(i).tolist() for f in files for i in range(f.documents)] == ids


def test_empty_table(spark, tmp_path):
    C.write_token_files(frame(spark, []), f"{tmp_path}/t", VOCABULARY)
    out = C.read_token_files(spark, f"{tmp_path}/t")
    assert out.count() == 0 and out.columns == ["doc_id", "start", "n_tokens", "ids"]


def test_query_equals_the_library(spark, sf, library):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    at, want = 0, []
    for doc_id, ids in expected(rows, library):
        want.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = op12_token_codes(spark, sf)
    assert dict(got.dtypes) == {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}
    assert sorted(map(tuple, got.collect())) == sorted(want)
