"""Substring de-duplication against an index of content-defined reference blocks.

A window of ``window`` words is a duplicate if the same words start a window
in a document of smaller id; the words that such windows cover go.  This is a
join of windows with the indexed blocks.  It finds what a greedy relative
Lempel-Ziv parse with factors of ``window`` words or more finds, the union of
all windows inside and across its factors, but it does not walk a document and
extend factors: there are no (start, length, reference) triples.

The index is never held in one place:

* Reference blocks are content-defined.  The window at word s belongs to the
  block of its anchor, the k-gram of least hash among the window's k-grams.
  Equal windows have equal anchors, so equal windows meet under one key, and
  about two of eleven words are anchors: one short row per block leaves a
  task instead of one row per word.  A block row holds the anchor's 64-bit
  hash and 40 more bits for each of its windows.
* Pre-aggregation: in each chunk of texts (``CHUNK_BYTES``) windows that also
  start in a smaller id of the same chunk are settled at once and not
  indexed.  So a passage that stands in a third of all documents sends one
  row per chunk to its key, not one per document.
* Blocks are partitioned by anchor and sorted by (anchor, id).  A task streams
  over them and keeps only the windows of the anchor at hand, not its rows.
* A short phrase with other words around it in many documents is the anchor of
  ever new windows.  Block rows are counted by anchor first (a sample of
  one in ``SAMPLE``); rows of anchors above ``HOT_ROWS`` are cut up into one per
  window under a key of its own hash, so no key holds more than about that.
* Spans go back to their documents as (anchor position, window bits).

Two different windows would have to agree in 64 + 40 bits of hash to be taken
for equal, or in 40 bits under one anchor (64 if it is a frequent one).

Cases: null and empty texts have no words; texts below ``window`` words have
no windows; rows that share an id don't remove words from each other, whether
repeated or of different texts (which are told apart by a hash of the text);
a row without an id is neither parsed nor a reference and keeps its words; an
empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortproof._pickling import ship_by_value
from sortproof.llm.utf8 import blocks, flat, mix64, whole_windows, window_hashes, word_hashes, word_spans

#: Words of a window; the contract's passage length.
WINDOW = 13
#: Words of an anchor.
ANCHOR = 4
#: Texts whose windows are compared with each other before anything is shuffled.
CHUNK_BYTES = 8_000_000
#: Block rows of an anchor from which its windows part, about.
HOT_ROWS = 65_536
#: One of so many block rows is counted, by hash.
SAMPLE = 64

_U64 = np.uint64
_RESIDUE = 5  # bytes of a window's own hash in a block row
_TAG_BITS = 24


def _least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost least value of each run of ``width`` values."""
    n = len(values)
    best, size = np.arange(n), 1
    while size < width:
        step = min(size, width - size)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        size += step
    return best


def _pack(place: np.ndarray, bits: np.ndarray, tag: np.ndarray, span: int) -> np.ndarray:
    return (place << (span + _TAG_BITS)) | (bits << _TAG_BITS) | tag


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary per row: the ``_RESIDUE`` low bytes of the row's values."""
    raw = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_RESIDUE])
    ends = np.append(0, np.cumsum(counts) * _RESIDUE).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes())])


def _block_rows(chunk: pa.RecordBatch, window: int, anchor: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows ``anchor, doc, place, residues`` of a chunk; residues are null where already settled.

    Windows of the anchors ``hot`` have a row each, under a key in place of the anchor.
    """
    span = window - anchor + 1
    ids = np.asarray(chunk.column("_id"), np.int64)
    tags = np.asarray(chunk.column("_tag"), np.int64)
    words, first = word_hashes(*flat(chunk.column("_text")))
    starts, owner = whole_windows(first, window, len(words))
    if not len(starts):
        return
    hashes = window_hashes(words, window)[starts]
    grams = window_hashes(words, anchor)
    at = _least_in_window(grams, span)[starts]
    doc = ids[owner]
    # settled here: the same window in a smaller id of this chunk
    order = np.lexsort((doc, hashes))
    h, d = hashes[order], doc[order]
    new = np.append(True, h[1:] != h[:-1])
    least = d[np.flatnonzero(new)][np.cumsum(new) - 1]
    settled = np.zeros(len(h), bool)
    settled[order] = d > least
    bit = np.int64(1) << (span - 1 - (at - starts))
    place = at - first[owner]
    for done in (False, True):
        rows = np.flatnonzero(settled == done)
        if not len(rows):
            continue
        begins = np.append(True, (at[rows][1:] != at[rows][:-1]) | (owner[rows][1:] != owner[rows][:-1]))
        apart = np.zeros(len(rows), bool) if done else np.isin(grams[at[rows]].view(np.int64), hot)
        head = np.flatnonzero(begins | apart)
        lead = rows[head]
        bits = np.add.reduceat(bit[rows], head)
        packed = _pack(place[lead], bits, tags[owner[lead]], span)
        counts = np.diff(np.append(head, len(rows)))
        key = mix64(doc[lead].astype(_U64)) if done else grams[at[lead]]
        key = np.where(apart[head], mix64(hashes[lead] ^ mix64(key)), key)
        residues = pa.nulls(len(lead), pa.binary()) if done else _binary(hashes[rows], counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), pa.array(doc[lead]), pa.array(packed), residues],
            ["anchor", "doc", "place", "residues"],
        )


def _windows_of(batch: pa.RecordBatch, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bit, residue) of every window in block rows."""
    bits = (np.asarray(batch.column("place"), np.int64) >> _TAG_BITS) & ((1 << span) - 1)
    row, bit = np.nonzero((bits[:, None] >> np.arange(span)) & 1)
    column = batch.column("residues")
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(-1, _RESIDUE)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :_RESIDUE] = raw
    return row, bit, wide.view("<u8").ravel()


def _match(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """Windows seen before under their anchor, from rows sorted by (anchor, doc)."""
    at_hand, seen = None, {}  # of the last anchor: residue -> smallest doc
    for batch in batches:
        settled = np.asarray(batch.column("residues").is_null())
        if settled.any():
            part = batch.filter(pa.array(settled))
            yield pa.RecordBatch.from_arrays([part.column("doc"), part.column("place")], ["doc", "place"])
            batch = batch.filter(pa.array(~settled))
        if not batch.num_rows:
            continue
        anchors = np.asarray(batch.column("anchor"), np.int64)
        docs = np.asarray(batch.column("doc"), np.int64)
        row, bit, residue = _windows_of(batch, span)
        group = np.cumsum(np.append(False, anchors[1:] != anchors[:-1])).astype(_U64)
        key = (group[row] << _U64(8 * _RESIDUE)) | residue
        order = np.argsort(key, kind="stable")
        k = key[order]
        new = np.append(True, k[1:] != k[:-1])
        least = docs[row[order[new]]]  # rows are in order of doc
        if at_hand == anchors[0]:
            for i in np.flatnonzero(group[row[order[new]]] == 0):
                least[i] = min(least[i], seen.get(int(residue[order[new]][i]), least[i]))
        else:
            seen = {}
        found = np.zeros(len(key), bool)
        found[order] = docs[row[order]] > least[np.cumsum(new) - 1]
        if anchors[-1] != at_hand:
            seen = {} if anchors[-1] != anchors[0] else seen
        at_hand = anchors[-1]
        tail = np.flatnonzero(group[row[order[new]]] == group[-1])
        seen.update(zip(residue[order[new]][tail].tolist(), least[tail].tolist(), strict=True))
        hit = np.flatnonzero(found)
        if len(hit):
            head = np.flatnonzero(np.append(True, row[hit][1:] != row[hit][:-1]))
            bits = np.add.reduceat(np.int64(1) << bit[hit].astype(np.int64), head)
            place = np.asarray(batch.column("place"), np.int64)[row[hit][head]]
            mask = ((1 << span) - 1) << _TAG_BITS
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs[row[hit][head]]), pa.array((place & ~mask) | (bits << _TAG_BITS))], ["doc", "place"]
            )


def _tag(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit(""))).bitwiseAND(F.lit((1 << _TAG_BITS) - 1))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("_id"), _tag("text").alias("_tag"), F.col("text").alias("_text")
    )


def _hot_anchors(docs: DataFrame, window: int, anchor: int) -> np.ndarray:
    """Anchors of more than about ``HOT_ROWS`` block rows: a bounded share of all rows, so few."""
    none, sample = np.empty(0, np.int64), SAMPLE

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in blocks(batch, "_text", CHUNK_BYTES):
                for rows in _block_rows(chunk, window, anchor, none):
                    if rows.column("residues").null_count:
                        continue
                    doc, place = (np.asarray(rows.column(c), np.int64).view(_U64) for c in ("doc", "place"))
                    own = np.asarray(rows.column("anchor"), np.int64)[mix64(doc ^ mix64(place)) % _U64(sample) == 0]
                    keys, n = np.unique(own, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n, pa.int64())], ["anchor", "n"])

    counts = _texts(docs).mapInArrow(count, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") * SAMPLE > HOT_ROWS).select("anchor").collect()
    return np.array(sorted(r["anchor"] for r in found), np.int64)


def _indexed(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """Block rows ``anchor, doc, place, residues`` of all documents."""
    hot = _hot_anchors(docs, window, anchor)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in blocks(batch, "_text", CHUNK_BYTES):
                yield from _block_rows(chunk, window, anchor, hot)

    return _texts(docs).mapInArrow(cut, "anchor long, doc long, place long, residues binary")


def duplicate_places(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``_id, _tag, places`` for documents with duplicate windows (packed positions and window bits)."""
    span = window - anchor + 1
    if not 1 <= span <= 16:
        raise ValueError("anchor must be 0 to 15 words shorter than the window")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _match(batches, span)

    return (
        _indexed(docs, window, anchor)
        .repartition("anchor")
        .sortWithinPartitions("anchor", "doc")
        .mapInArrow(match, "doc long, place long")
        .groupBy(F.col("doc").alias("_id"), F.col("place").bitwiseAND(F.lit((1 << _TAG_BITS) - 1)).alias("_tag"))
        .agg(F.collect_list("place").alias("places"))
    )


def _removed(places: np.ndarray, n_words: int, window: int, span: int) -> np.ndarray:
    """Which of a document's words lie in a duplicate window."""
    bits = (places >> _TAG_BITS) & ((1 << span) - 1)
    row, bit = np.nonzero((bits[:, None] >> np.arange(span)) & 1)
    start = (places >> (span + _TAG_BITS))[row] - (span - 1) + bit
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + window, -1)
    return np.cumsum(edge)[:n_words] > 0


def remove_duplicate_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, n_words, n_removed, spans, kept`` of every document of ``doc_id, text``.

    ``spans`` are the removed runs of words (start, length); ``kept`` is the
    other words joined by single blanks.
    """
    span = window - anchor + 1
    found = duplicate_places(docs, window, anchor)
    left = docs.select("doc_id", "text", F.col("doc_id").cast("long").alias("_id"), _tag("text").alias("_tag"))
    joined = left.join(found, ["_id", "_tag"], "left").select("doc_id", "text", "places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                data, offsets = flat(block.column("text"))
                starts, ends, first = word_spans(data, offsets)
                raw = data.tobytes()
                last = np.append(first[1:], len(starts)) if len(first) else first
                out: tuple[list, list, list, list] = ([], [], [], [])
                for i, places in enumerate(block.column("places")):
                    a, b = int(first[i]), int(last[i])
                    gone = np.zeros(b - a, bool)
                    if places.is_valid and len(places):
                        gone = _removed(np.asarray(places.values, np.int64), b - a, window, span)
                    keep = np.flatnonzero(~gone) + a
                    edges = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
                    out[0].append(b - a)
                    out[1].append(int(gone.sum()))
                    out[2].append([{"start": int(s), "length": int(e - s)} for s, e in edges.reshape(-1, 2)])
                    out[3].append(b" ".join(raw[s:e] for s, e in zip(starts[keep].tolist(), ends[keep].tolist(), strict=True)).decode())
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                        pa.array(out[2], pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                        pa.array(out[3], pa.string()),
                    ],
                    ["doc_id", "n_words", "n_removed", "spans", "kept"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(
        cut, f"doc_id {kind}, n_words long, n_removed long, spans array<struct<start:long,length:long>>, kept string"
    )


def substring_dedup_digest(docs: DataFrame) -> DataFrame:
    """The operator's result per document, the kept text as a hash."""
    return remove_duplicate_spans(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


SUBSTRING_DEDUP_SQL = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), starts AS (
  SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS passage
  FROM words, LATERAL (SELECT unnest(generate_series(1, len(w) - 12)) AS s)
), least AS (
  SELECT passage, min(doc_id) AS first_id FROM starts GROUP BY passage HAVING min(doc_id) < max(doc_id)
), hits AS (
  SELECT doc_id, s FROM starts JOIN least USING (passage) WHERE doc_id > first_id
), gone AS (
  SELECT DISTINCT doc_id, s + k AS pos FROM hits, (SELECT unnest(generate_series(0, 12)) AS k)
), placed AS (
  SELECT doc_id, pos, w[pos] AS word FROM words, LATERAL (SELECT unnest(generate_series(1, len(w))) AS pos)
), kept AS (
  SELECT p.doc_id, count(g.pos) AS n_removed,
         sha256(coalesce(string_agg(p.word, ' ' ORDER BY p.pos) FILTER (WHERE g.pos IS NULL), '')) AS kept_sha256
  FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.pos = g.pos GROUP BY p.doc_id
)
SELECT w.doc_id, len(w.w) AS n_words, coalesce(k.n_removed, 0) AS n_removed, coalesce(k.kept_sha256, sha256('')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""

ship_by_value(__name__)
