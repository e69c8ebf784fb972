"""Texts of an Arrow batch as flat numpy arrays: bytes, words, hashes.  No per-row Python."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from sortproof._pickling import ship_by_value

#: Texts are worked on in blocks of about so many bytes, a longer text alone.
BLOCK_BYTES = 2_000_000

# Odd multiplier of the polynomial hashes (arithmetic modulo 2^64).
_BASE = 0x9E3779B97F4A7C15
_U64 = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shift and multiply)."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U64(27))
    x = x * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty."""
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batch: pa.RecordBatch, text: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``size`` bytes together, one row at least."""
    if not batch.num_rows:
        return
    _, offsets = flat(batch.column(batch.schema.get_field_index(text)))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def powers(n: int, base: int) -> np.ndarray:
    """base^0 .. base^n modulo 2^64."""
    out = np.empty(n + 1, _U64)
    out[0] = 1
    done = 1
    while done <= n:
        m = min(done, n + 1 - done)
        out[done : done + m] = out[:m] * out[done - 1 : done] * _U64(base)
        done += m
    return out


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """A 64-bit hash of each span of bytes, a function of its bytes alone."""
    n = len(data)
    inverse = pow(base, -1, 1 << 64)
    sums = np.zeros(n + 1, _U64)
    # bytes + 1, so that runs of zero bytes of different lengths differ
    np.cumsum((data.astype(_U64) + _U64(1)) * powers(n, base)[:n], out=sums[1:])
    values = (sums[ends] - sums[starts]) * powers(n, inverse)[starts]
    return mix64(values + mix64((ends - starts).astype(_U64)))


# The white space of the contracts, U+0020 and U+0009 to U+000D.
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_spans(
    data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = _IS_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of all words; ``first[i]`` is the index of text i's first word.

    ``apart`` says of each byte value whether it stands between words.
    """
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~apart[data]
    begins = inside[1:-1] & ~inside[:-2]
    stops = inside[1:-1] & ~inside[2:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    begins[edges] |= inside[edges + 1]  # words end where their text ends
    stops[edges - 1] |= inside[edges]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, index of each text's first word)."""
    starts, ends, first = word_spans(data, offsets)
    return span_hashes(data, starts, ends), first


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive values (also across texts; see ``whole_windows``)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, _U64)
    out = np.zeros(n, _U64)
    for i in range(k):
        out = out * _U64(0xD6E8FEB86659FD93) + words[i : i + n]
    return mix64(out)


def whole_windows(first: np.ndarray, k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(window starts, text of each) of the windows of k words that lie in one text; n words in all."""
    counts = np.diff(np.append(first, n)) if len(first) and first[-1] != n else np.diff(first)
    room = np.maximum(counts - k + 1, 0)
    owner = np.repeat(np.arange(len(room)), room)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(room) - room, room)
    return first[owner] + within, owner


ship_by_value(__name__)
