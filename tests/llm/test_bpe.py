import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from sortproof.llm import bpe, utf8

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec.from_file(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(codec, texts):
    ids, at = codec.encode(*utf8.flat(pa.array(texts, pa.string())))
    data, upto = codec.decode(ids, at)
    for t, a, b in zip(texts, upto[:-1], upto[1:], strict=True):
        assert data[a:b].tobytes().decode() == (t or "")
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]


PARTS = ["a", "b", "'s", "'", "'ll", "'re", " ", "  ", "\n", "\t", " ", "　", "1", "²", "é", "中", "😀", "!!", "'t", "\x1c", "\x85", "​", "tion", "<|endoftext|>", "A"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=25).map("".join), max_size=6))
def test_same_tokens_as_the_library(codec, library, texts):
    assert encode(codec, texts) == [library.encode_ordinary(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=40))
def test_any_text_round_trips(codec, library, text):
    assert encode(codec, [text, text]) == [library.encode_ordinary(text)] * 2


def test_long_pieces_merge_through_the_heap(codec, library):
    rng = random.Random(2)
    texts = ["a" * 6000, "".join(rng.choice("abcdeft") for _ in range(5000)), "é" * 3000, "=" * 4097, " " * 5000 + "x"]
    assert encode(codec, texts) == [library.encode_ordinary(t) for t in texts]


def test_matrix_and_heap_agree(codec):
    rng = random.Random(3)
    pieces = ["".join(rng.choice("theranoi") for _ in range(rng.randint(2, 90))).encode() for _ in range(300)]
    for piece, tokens in zip(pieces, codec.encode_pieces(pieces), strict=True):
        if piece not in codec.ranks:
            assert codec._merge_long(piece).tolist() == tokens.tolist()


def test_other_patterns_go_through_the_regex_library(library):
    own = bpe.Codec.from_file(PATH, r"\p{L}+|\s+|[^\p{L}\s]+")
    texts = ["Ein Wort, noch 1 Wörtchen", "", "x\n\ny"]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    want = tiktoken.Encoding("x", pat_str=own.pattern, mergeable_ranks=ranks, special_tokens={})
    assert encode(own, texts) == [want.encode_ordinary(t) for t in texts]


def test_digest(docs_df, codec, library, clashing):
    rows = [(1, "Hello there's 12 words"), (1, "Hello there's 12 words"), (2, None), (3, ""), (None, "ü\n ü"), (5, "x" * 20_000)]
    out = sorted(map(tuple, bpe.bpe_digest(docs_df(rows, clashing), codec).collect()), key=repr)
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert out == sorted(want, key=repr)
    assert bpe.bpe_digest(docs_df([(1, "x")]).limit(0), codec).count() == 0


def test_encode_and_decode_documents(docs_df, codec):
    df = docs_df([(1, "some text"), (2, None)])
    back = {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode_documents(bpe.encode_documents(df, codec), codec).collect()}
    assert back == {1: b"some text", 2: b""}
