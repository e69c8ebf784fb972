"""Byte-level BPE encoding and decoding in numpy.

Method: the distinct pieces of a block of texts are bucketed by length into
padded matrices of token ids.  In every round each row merges its leftmost
pair of minimum rank; ranks come from a hashed table of pairs (open
addressing), and rows close the gap and leave the matrix when no pair is
left.

* Splitting texts into pieces is done on arrays of code points by character
  class.  It gives the matches of ``PIECE_PATTERN``; any other pattern goes
  through the regex library.
* A piece that is itself in the vocabulary is one token, without merging.
* Pieces above ``LONG_PIECE`` bytes would cost the square of their length in a
  matrix; they merge through a heap of pairs (leftmost minimum rank again),
  so any length works.
* Spark hands each task a part of the rows; a task holds one block of about
  2 MB of text at a time (a longer text alone).  The tables depend on the
  vocabulary file only and go to the tasks with the function.

Cases: null and empty texts have no tokens and decode to no bytes; repeated
rows are encoded alike; an empty table gives an empty table; columns other
than those named don't matter.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sortproof._pickling import ship_by_value
from sortproof.llm.utf8 import blocks, flat, span_hashes

# Fixed value: the piece pattern of the public vocabulary files.
PIECE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Longer pieces (bytes) merge through a heap.
LONG_PIECE = 2048
#: Pieces up to this length have a bucket for each length; longer ones share buckets by power of 1.25.
EXACT_BUCKETS = 32

_OTHER, _LETTER, _NUMBER, _SPACE = range(4)
_NONE = np.int32(np.iinfo(np.int32).max)
_SECOND_BASE = 0xC2B2AE3D27D4EB4F


class PairRanks:
    """Rank of a pair of token ids; a hash table with open addressing, looked up for whole arrays."""

    def __init__(self, pairs: dict[tuple[int, int], int]) -> None:
        self.bits = max(4, (4 * max(1, len(pairs)) - 1).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, np.iinfo(np.uint64).max, np.uint64)
        self.ranks = np.full(size, _NONE, np.int32)
        keys = np.array([(a << 32) | b for a, b in pairs], np.uint64)
        ranks = np.array(list(pairs.values()), np.int32)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == np.iinfo(np.uint64).max
            _, first = np.unique(slots, return_index=True)
            placed = np.zeros(len(keys), bool)
            placed[first] = free[first]
            self.keys[slots[placed]], self.ranks[slots[placed]] = keys[placed], ranks[placed]
            keys, ranks, slots = keys[~placed], ranks[~placed], (slots[~placed] + 1) & (size - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; ``_NONE`` where there is none or an id is negative (padding)."""
        keys = (left.astype(np.int64).astype(np.uint64) << np.uint64(32)) | (right.astype(np.int64).astype(np.uint64) & np.uint64(0xFFFFFFFF))
        slots = self._slots(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.ranks[slots], _NONE)
        open_ = np.flatnonzero((found != keys) & (found != np.iinfo(np.uint64).max))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.ranks[slots[open_[hit]]]
            open_ = open_[~hit & (found != np.iinfo(np.uint64).max)]
        out[(left < 0) | (right < 0)] = _NONE
        return out


class Codec:
    """Encoder and decoder of one vocabulary: token bytes by rank, which is the token's id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PIECE_PATTERN) -> None:
        self.pattern = pattern
        self.ranks = ranks
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left, right] = rank
        self.pairs = PairRanks(pairs)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        by_rank = sorted(ranks.items(), key=lambda x: x[1])
        top = by_rank[-1][1] + 1 if by_rank else 0
        self.token_length = np.zeros(top, np.int64)
        self.token_length[[r for _, r in by_rank]] = [len(t) for t, _ in by_rank]
        self.token_bytes = np.frombuffer(b"".join(t for t, _ in by_rank), np.uint8)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.classes = _character_classes() if pattern == PIECE_PATTERN else None

    @classmethod
    def from_file(cls, path: str, pattern: str = PIECE_PATTERN) -> Codec:
        """From a file of lines ``base64(token) rank``."""
        with open(path, "rb") as f:
            pairs = (line.split() for line in f if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)

    # -- pieces -----------------------------------------------------------
    def pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) in bytes of all pieces of the texts, in order."""
        if self.classes is None:
            return self._pieces_by_regex(data, offsets)
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        leads = np.flatnonzero((data & 0xC0) != 0x80)  # byte offset of every character
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        at = np.append(leads, len(data))
        firsts = np.searchsorted(leads, offsets[:-1][np.diff(offsets) > 0])
        starts = _piece_starts(points, self.classes[points], firsts)
        edges = at[np.append(starts, len(points))]
        return edges[:-1], edges[1:]

    def _pieces_by_regex(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        import regex

        find, starts, ends = regex.compile(self.pattern).finditer, [], []
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            text = data[a:b].tobytes().decode()
            size = np.append(0, np.cumsum([len(c.encode()) for c in text])).astype(np.int64) + a
            spans = [m.span() for m in find(text)]
            starts += [size[s] for s, e in spans if e > s]
            ends += [size[e] for s, e in spans if e > s]
        return np.array(starts, np.int64), np.array(ends, np.int64)

    # -- merging ----------------------------------------------------------
    def _merge_matrix(self, ids: np.ndarray) -> list[np.ndarray]:
        """Tokens of each row of byte ids, padded with -1 on the right."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(ids)
        rows = np.arange(len(ids))
        ranks = self.pairs(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        while len(rows):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            best = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), _NONE)
            done = best == _NONE
            if done.any():
                for r, row in zip(rows[done], ids[done], strict=True):
                    out[r] = row[row >= 0]
                keep = ~done
                rows, ids, ranks, at, best = rows[keep], ids[keep], ranks[keep], at[keep], best[keep]
                if not len(rows):
                    break
            # the pair becomes its token, what follows moves up by one
            every, width = np.arange(len(rows)), ids.shape[1]
            ids[every, at] = best
            take = np.arange(width - 1)[None, :] + (np.arange(width - 1)[None, :] > at[:, None])
            ids = np.take_along_axis(ids, take, 1)
            if width > 2:
                take = np.arange(width - 2)[None, :] + (np.arange(width - 2)[None, :] > at[:, None])
                ranks = np.take_along_axis(ranks, take, 1)
                left = np.flatnonzero(at > 0)
                ranks[left, at[left] - 1] = self.pairs(ids[left, at[left] - 1], ids[left, at[left]])
                right = np.flatnonzero(at < width - 2)
                ranks[right, at[right]] = self.pairs(ids[right, at[right]], ids[right, at[right] + 1])
            else:
                ranks = np.zeros((len(rows), 0), np.int32)
        return out

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """Tokens of one very long piece: a linked list, and a heap of (rank, place)."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get = {}

        def rank(i: int) -> int:
            pair = ids[i], ids[after[i]]
            if pair not in get:
                get[pair] = int(self.pairs(np.array(pair[:1]), np.array(pair[1:]))[0])
            return get[pair]

        heap = [(r, i) for i in range(n - 1) if (r := rank(i)) != _NONE]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or after[i] >= n or rank(i) != r:
                continue
            gone = after[i]
            ids[i], ids[gone], after[i] = r, -1, after[gone]
            if after[i] < n:
                before[after[i]] = i
                if (q := rank(i)) != _NONE:
                    heapq.heappush(heap, (q, i))
            if before[i] >= 0 and (q := rank(before[i])) != _NONE:
                heapq.heappush(heap, (q, before[i]))
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Tokens of each piece."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            n = len(piece)
            if whole is not None:
                out[i] = np.array([whole], np.int32)
            elif n > LONG_PIECE:
                out[i] = self._merge_long(piece)
            elif n:
                width = n if n <= EXACT_BUCKETS else int(np.ceil(1.25 ** np.ceil(np.log(n) / np.log(1.25) - 1e-9)))
                buckets.setdefault(width, []).append(i)
        for width, members in buckets.items():
            step = max(1, 4_000_000 // width)
            for at in range(0, len(members), step):
                part = members[at : at + step]
                raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in part), np.uint8).reshape(-1, width)
                ids = self.byte_id[raw]
                lengths = np.array([len(pieces[i]) for i in part])
                ids[np.arange(width)[None, :] >= lengths[:, None]] = -1
                for i, tokens in zip(part, self._merge_matrix(ids), strict=True):
                    out[i] = tokens
        return out

    # -- texts ------------------------------------------------------------
    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts given as bytes and offsets."""
        starts, ends = self.pieces(data, offsets)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        first_hash, second = span_hashes(data, starts, ends), span_hashes(data, starts, ends, _SECOND_BASE)
        _, sample, which = np.unique(first_hash, return_index=True, return_inverse=True)
        if not np.array_equal(second[sample][which], second):  # a collision: tell pieces apart by both
            _, sample, which = np.unique(np.stack([first_hash, second], 1), axis=0, return_index=True, return_inverse=True)
            which = which.ravel()
        raw = data.tobytes()
        tokens = self.encode_pieces([raw[a:b] for a, b in zip(starts[sample].tolist(), ends[sample].tolist(), strict=True)])
        sizes = np.array([len(t) for t in tokens], np.int64)
        pool, begin = np.concatenate(tokens), np.cumsum(sizes) - sizes
        ids = pool[_ranges(begin[which], sizes[which])]
        upto = np.append(0, np.cumsum(sizes[which]))
        return ids, upto[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the texts given as ids and offsets."""
        sizes = self.token_length[ids]
        data = self.token_bytes[_ranges(self.token_start[ids], sizes)]
        return data, np.append(0, np.cumsum(sizes))[offsets]


def _ranges(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (sizes[0] of them), begin[1], ..."""
    shift = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
    return shift + np.arange(len(shift))


def _character_classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    import regex

    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    chars = "".join(map(chr, points))
    at = np.array(points)
    out = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for m in regex.finditer(pattern, chars):
            out[at[m.start() : m.end()]] = kind
    return out


def _piece_starts(points: np.ndarray, kinds: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Start of every match of ``PIECE_PATTERN``; ``firsts`` are the starts of the texts."""
    n = len(points)
    new_text = np.zeros(n, bool)
    new_text[firsts] = True
    # a piece begins where the class changes
    begins = new_text.copy()
    begins[1:] |= kinds[1:] != kinds[:-1]
    space = kinds == _SPACE
    # white space before a word: its last character stands apart, or, if a blank, joins the word
    last_space = np.zeros(n, bool)
    last_space[:-1] = space[:-1] & ~space[1:] & ~new_text[1:]
    joins = last_space & (points == 0x20)
    begins |= last_space
    follows = np.flatnonzero(joins) + 1
    begins[follows] = False
    # contractions: an apostrophe that begins a piece takes one of s t m d, or re ve ll
    quote = np.flatnonzero(begins & (points == 0x27))
    quote = quote[quote + 1 < n]
    if len(quote):
        def char(k: int) -> np.ndarray:
            p = np.minimum(quote + k, n - 1)
            inside = quote + k < n
            for j in range(1, k + 1):
                inside &= ~new_text[np.minimum(quote + j, n - 1)]
            return np.where(inside, points[p], 0)

        one, two = char(1), char(2)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        size = np.where(short, 2, np.where(long, 3, 0))
        quote, size = quote[size > 0], size[size > 0]
        begins[quote + 1] = False
        rest = quote + size
        ok = rest < n
        # letters left over from the run begin a piece of their own
        begins[rest[ok]] |= kinds[rest[ok]] == _LETTER
    return np.flatnonzero(begins)


def _text_batches(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from blocks(batch, text)


def encode_documents(docs: DataFrame, codec: Codec) -> DataFrame:
    """``doc_id`` and ``ids`` (array<int>) of every document of ``doc_id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _text_batches(batches, "text"):
            ids, at = codec.encode(*flat(block.column("text")))
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), lists], ["doc_id", "ids"])

    source = docs.select("doc_id", "text")
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def _lists(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    ids = ids.fill_null([]) if ids.null_count else ids
    at = np.asarray(ids.offsets, np.int64)
    return np.asarray(ids.values, np.int32)[at[0] : at[-1]], at - at[0]


def decode_documents(encoded: DataFrame, codec: Codec) -> DataFrame:
    """``doc_id``, ``ids_bytes`` (ids as little-endian unsigned 32-bit integers) and ``decoded`` (bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids, ends = _lists(part.column("ids"))
                data, upto = codec.decode(ids, ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        _binaries(ids.astype("<u4").view(np.uint8), ends * 4),
                        _binaries(data, upto),
                    ],
                    ["doc_id", "ids_bytes", "decoded"],
                )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids_bytes binary, decoded binary")


def _binaries(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())],
    ).cast(pa.binary())


def bpe_digest(docs: DataFrame, codec: Codec) -> DataFrame:
    """Encoded and decoded again: the number of tokens and hashes of both results per document."""
    encoded = encode_documents(docs, codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at = _lists(batch.column("ids"))
            rows: tuple[list, list, list] = ([], [], [])
            for a, b in zip(at[:-1], at[1:], strict=True):
                own = ids[a:b]
                data, _ = codec.decode(own, np.array([0, b - a]))
                rows[0].append(int(b - a))
                rows[1].append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                rows[2].append(hashlib.sha256(data.tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


ship_by_value(__name__)
