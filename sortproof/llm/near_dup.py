"""Near-duplicate documents: weighted MinHash over TF-IDF shingles, banded and verified.

A document is the weighted set of its word 5-grams (texts of 1 to 4 words: one
shingle); a shingle weighs its count in the text times its idf.  Two documents
are linked if the weighted Jaccard similarity (sum of minima over sum of
maxima) is 0.8 or more; the classes are the connected components of the links.

1. Document frequencies are counted over all documents in a count-min sketch
   of fixed size.  Frequencies below about (mean shingles per document /
   ``WIDTH``) of all documents are not told apart, at any size of the corpus;
   what idf is for, passages that stand in a percent of all documents or
   more, is far above.  idf runs from 1 to ``1 + IDF_SPAN``: copies that are
   themselves numerous stay alike.
2. Improved consistent weighted sampling: ``BANDS * ROWS`` samples per
   document, the least of a value per shingle drawn from (shingle, sample)
   and its weight.  The draws (r, c, beta) come from 64 hash bits each, so
   they are as fine in texts of millions of shingles as in short ones.
3. Documents with equal texts are one node.  Nodes that agree in a band meet
   in a bucket.  A bucket's pairs aren't enumerated: first each node is
   verified against the leaders of its buckets that it shares most bands with.
   A bucket's leader is the member whose buckets are the fullest, which in a
   group of changed copies is the original or the copy nearest to it.
   Verified links give components.
4. Then only buckets that still hold several components are looked at, and only
   members outside the bucket's largest component are compared, by samples and
   in tiles of bounded size, with members of other components.  Texts meet
   again in pairs of larger tiles, if these hold a pair whose sampled
   similarity reaches ``ESTIMATE_FROM``; there every such pair that isn't
   joined yet is verified exactly.  Only links that join components leave a
   task.  So a pair that shares
   a bucket is either verified, or in one component already, or clearly
   dissimilar.

At similarity 0.8, 20 bands of 5 miss a pair with a probability of 0.0004, and
five standard errors lie between 0.8 and ``ESTIMATE_FROM``.

Cases: null and empty texts are equal texts without shingles (one class);
rows that are equal in id and text are one document, of which one row stays;
a row without an id is told apart by its text, and stands for its class only
if no row with an id does; an empty table gives an empty table; extra columns
stay untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sortproof._pickling import ship_by_value
from sortproof.llm.components import components
from sortproof.llm.utf8 import blocks, flat, mix64, whole_windows, window_hashes, word_hashes
from sortproof.session import scratch_path, write_and_read

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 5
DEPTH, WIDTH = 4, 1 << 16
IDF_SPAN = 0.25
ESTIMATE_FROM = 0.6
#: Shingles that may be sampled: those with a value below this over their text's weight.
LIKELY = 4.0
#: Shingles sampled at once, about.
CACHED = 16_384
#: Shingles of the texts on one side of a verification tile, about.
TILE_SHINGLES = 50_000
#: Shingles of the texts in a tile of open buckets, about: what a task verifies is two such tiles.
OPEN_SHINGLES = 400_000
#: Members on one side of a comparison tile, about.
TILE_MEMBERS = 1000
LEADERS = 2
SEED = 77

_U64 = np.uint64
_NO_ID = (1 << 63) - 1


# -- shingles and weights ------------------------------------------------------

def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, count) of the distinct shingles of each text, ordered by row and shingle."""
    words, first = word_hashes(*flat(texts))
    counts = np.diff(first)
    at, owner = whole_windows(first, SHINGLE, len(words))
    values = window_hashes(words, SHINGLE)[at]
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        own = [words[first[i] : first[i + 1]] for i in short]
        few = np.array([mix64(_fold(w))[0] for w in own], _U64)
        owner, values = np.append(owner, short), np.append(values, few)
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    if not len(values):
        return owner, values, owner
    head = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])))
    return owner[head], values[head], np.diff(np.append(head, len(values)))


def _fold(words: np.ndarray) -> np.ndarray:
    out = np.array([len(words)], _U64)
    for w in words:
        out = mix64(out ^ w)
    return out


def _cells(values: np.ndarray) -> list[np.ndarray]:
    """Cells of the sketch, one array per depth."""
    odd = np.random.default_rng(SEED).integers(1, 1 << 62, DEPTH, np.uint64) * _U64(2) + _U64(1)
    shift = _U64(64 - (WIDTH - 1).bit_length())
    return [((values * m) >> shift).astype(np.int64) for m in odd]


class Weights:
    """idf of shingles from the sketch of document frequencies."""

    def __init__(self, sketch: np.ndarray, documents: int) -> None:
        self.documents = max(1, documents)
        least = 1.0 / WIDTH  # of all documents
        share = np.clip(sketch / self.documents, least, 1.0)
        self.idf = (1 + IDF_SPAN * np.log(share) / np.log(least)).astype(np.float32)

    def __call__(self, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
        # the least count of the cells is the best one: the greatest idf
        best = np.zeros(len(values), np.float32)
        for row, cell in zip(self.idf, _cells(values), strict=True):
            np.maximum(best, row[cell], out=best)
        return counts * best.astype(np.float64)


def _sum_parts(parts: DataFrame, keys: list[str]) -> DataFrame:
    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x, np.int64) for x in group["cells"]], axis=0)
        return group.head(1).assign(cells=[total.tobytes()])

    return parts.groupBy(*keys).applyInPandas(add, parts.schema)


def document_frequencies(texts: DataFrame, column: str) -> Weights:
    """The weights for a corpus: one pass, and partial sketches summed in three steps of 64."""
    slices = 32
    size = DEPTH * WIDTH // slices

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, documents = np.zeros((DEPTH, WIDTH), np.int64), 0
        for batch in batches:
            for block in blocks(batch, column):
                row, values, _ = shingles(block.column(column))
                documents += len(np.unique(row))
                for own, cell in zip(total, _cells(values), strict=True):
                    own += np.bincount(cell, minlength=WIDTH)
        if documents:
            flat_cells = total.ravel()
            rows = [flat_cells[i * size : (i + 1) * size].tobytes() for i in range(slices)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(slices), pa.int32()), pa.array([documents] * slices, pa.int64()), pa.array(rows, pa.binary())],
                ["slice", "documents", "cells"],
            )

    parts = texts.select(column).mapInArrow(count, "slice int, documents long, cells binary")
    parts = parts.withColumn("part", F.spark_partition_id())
    with_count = parts.select(
        "slice", F.col("part").alias("p0"), F.floor(F.col("part") / 64).cast("int").alias("p1"),
        F.floor(F.col("part") / 4096).cast("int").alias("p2"),
        F.concat("cells", _long_bytes(F.col("documents"))).alias("cells"),
    )
    for keys in (["slice", "p1", "p2"], ["slice", "p2"], ["slice"]):
        with_count = _sum_parts(with_count, keys)
    rows = with_count.select("slice", "cells").collect()  # 32 rows of fixed size
    sketch, documents = np.zeros((slices, size), np.int64), 0
    for r in rows:
        cells = np.frombuffer(r["cells"], np.int64)
        sketch[r["slice"]], documents = cells[:-1], int(cells[-1])
    return Weights(sketch.reshape(DEPTH, WIDTH), documents)


def _long_bytes(value: Column) -> Column:
    """A long as 8 bytes, least first."""
    return F.unhex(
        F.concat(*[F.lpad(F.hex(F.shiftrightunsigned(value, 8 * i).bitwiseAND(F.lit(255))), 2, "0") for i in range(8)])
    )


# -- weighted samples ----------------------------------------------------------

def draw_table() -> np.ndarray:
    """Odd multipliers that turn a shingle's hash into the draws of a sample: a row per sample."""
    odd = np.random.default_rng(SEED + 2).integers(1, 1 << 62, (BANDS * ROWS, 2), np.uint64)
    return odd * _U64(2) + _U64(1)


def _product(hashed: np.ndarray) -> np.ndarray:
    """Product of the halves of 64 bits, each a uniform draw."""
    return (hashed >> _U64(32)) * (hashed & _U64(0xFFFFFFFF))


def _rough_product(hashed: np.ndarray) -> np.ndarray:
    """The same in (0, 1) to about six digits."""
    halves = hashed.view(np.uint32).astype(np.float32)
    return halves[::2] * halves[1::2] * np.float32(2.0**-64)


def _sampled(hashed: np.ndarray, odd: np.ndarray, log_w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log of the sampling value, what identifies it) of shingles for the sample of the multipliers ``odd``."""
    r = 64 * np.log(2) - np.log(np.maximum(_product(hashed * odd[0]), _U64(1)).astype(np.float64))  # r and c are of
    c = hashed * odd[1]  # two exponential draws each; log1p keeps the fine steps of a small c
    halves = (c >> _U64(32)).astype(np.float64), (c & _U64(0xFFFFFFFF)).astype(np.float64)
    with np.errstate(divide="ignore"):  # a draw of 0: an infinite value, never the least
        log_c = np.log(-np.log1p(halves[0] / 2**32 - 1) - np.log1p(halves[1] / 2**32 - 1))
    bits = mix64(hashed ^ odd[0])
    beta = (bits >> _U64(11)).astype(np.float64) / 2**53
    t = np.floor(log_w / r + beta)
    return log_c - r * (t - beta) - r, bits ^ t.astype(np.int64).view(_U64)  # log of c / (y e^r), y = exp(r (t - beta))


def samples(row: np.ndarray, values: np.ndarray, weights: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows with shingles, their ``BANDS * ROWS`` samples as 64-bit values)."""
    head = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    ends = np.append(head[1:], len(row))
    out = np.empty((len(head), len(table)), _U64)
    at = 0
    while at < len(head):  # as many texts at once as stay in the processor's cache
        to = max(at + 1, int(np.searchsorted(ends, head[at] + CACHED, "right")))
        a, b = head[at], ends[to - 1]
        out[at:to] = _least(head[at:to] - a, values[a:b], weights[a:b], table)
        at = to
    return row[head], mix64(out)


def _least(head: np.ndarray, values: np.ndarray, weights: np.ndarray, table: np.ndarray) -> np.ndarray:
    """What identifies the least sampling value, by text (starting at ``head``) and sample.

    A value is at least (1 - u) v / w, for u and v the products of the two
    uniform draws behind c and r.  So only shingles with that bound below
    ``LIKELY`` over their text's weight are worked out; a text without a value
    below it (one of e^LIKELY) is looked at as a whole.
    """
    text = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(values))))
    most = LIKELY / np.add.reduceat(weights, head)
    log_w, log_most, bound = np.log(weights), np.log(most), (weights * most[text] * (1 + 1e-5)).astype(np.float32)
    out = np.empty((len(head), len(table)), _U64)

    def settle(at: np.ndarray, k: int, whole: bool) -> np.ndarray:
        """Fill in the samples of the texts with shingles ``at`` as far as they are sure; these texts."""
        value, ident = _sampled(values[at], table[k], log_w[at])
        first = np.flatnonzero(np.append(True, text[at[1:]] != text[at[:-1]]))
        low = np.minimum.reduceat(value, first)
        least = np.repeat(low, np.diff(np.append(first, len(at)))) == value
        ident = np.minimum.reduceat(np.where(least, ident, ~_U64(0)), first)
        which = text[at[first]]
        sure = whole | (low <= log_most[which])
        out[which[sure], k] = ident[sure]
        return which[sure]

    for k, odd in enumerate(table):
        far = np.float32(1 - 1e-6) - _rough_product(values * odd[1])
        far *= _rough_product(values * odd[0])
        at = np.flatnonzero(far <= bound)
        done = np.zeros(len(head), bool)
        if len(at):
            done[settle(at, k, False)] = True
        if not done.all():
            settle(np.flatnonzero(~done[text]), k, True)
    return out


def _signatures(texts: DataFrame, weights: Weights) -> DataFrame:
    """``_id, _key, n, sig, bands`` per row: 2 bytes per sample, and a hash per band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = draw_table()
        numbers = mix64(np.arange(1, BANDS + 1, dtype=_U64))
        for batch in batches:
            for block in blocks(batch, "_text"):
                row, values, counts = shingles(block.column("_text"))
                n = np.bincount(row, minlength=block.num_rows)
                sig: list = [None] * block.num_rows
                bands = np.zeros((block.num_rows, BANDS), np.int64)
                if len(row):
                    rows, drawn = samples(row, values, weights(values, counts), table)
                    hashed = np.zeros((len(rows), BANDS), _U64)
                    for j in range(ROWS):
                        hashed = mix64(hashed * _U64(31) + drawn[:, j::ROWS])
                    bands[rows] = (mix64(hashed ^ numbers)).view(np.int64)
                    short = drawn.astype("<u2")
                    for i, r in enumerate(rows.tolist()):
                        sig[r] = short[i].tobytes()
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(block.num_rows + 1) * BANDS, pa.int32()), pa.array(bands.ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [block.column("_id"), block.column("_key"), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), lists],
                    ["_id", "_key", "n", "sig", "bands"],
                )

    return texts.select("_id", "_key", "_text").mapInArrow(
        run, "_id long, _key binary, n long, sig binary, bands array<long>"
    )


# -- verification --------------------------------------------------------------

def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Similarity of two sorted (shingles, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum()
    union = a[1].sum() + b[1].sum() - shared
    return float(shared / union) if union > 0 else 0.0


def _verify(pairs: DataFrame, tiles: DataFrame, texts: DataFrame, weights: Weights, similarity: float) -> DataFrame:
    """The pairs ``a, b`` that are similar enough; ``tiles`` has the tile of every node."""
    placed = (
        pairs.join(tiles.select(F.col("_key").alias("a"), F.col("tile").alias("ta")), "a")
        .join(tiles.select(F.col("_key").alias("b"), F.col("tile").alias("tb")), "b")
        .select("a", "b", F.least("ta", "tb").alias("t1"), F.greatest("ta", "tb").alias("t2"))
    )
    placed = write_and_read(placed, scratch_path(pairs.sparkSession, "near-pairs"))
    needed = placed.select("t1", "t2", F.explode(F.array("a", "b")).alias("_key")).distinct()
    carried = needed.join(texts, "_key").select(F.col("t1").alias("u1"), F.col("t2").alias("u2"), "_key", "_text")

    def run(own: pa.Table, others: pa.Table) -> pa.Table:
        out: tuple[list, list] = ([], [])
        if own.num_rows and others.num_rows:
            keys = others["_key"].to_pylist()
            row, values, counts = shingles(others["_text"].combine_chunks())
            w = weights(values, counts)
            at = np.searchsorted(row, np.arange(len(keys) + 1))
            sets = {k: (values[at[i] : at[i + 1]], w[at[i] : at[i + 1]]) for i, k in enumerate(keys)}
            for a, b in zip(own["a"].to_pylist(), own["b"].to_pylist(), strict=True):
                if weighted_jaccard(sets[a], sets[b]) >= similarity:
                    out[0].append(a)
                    out[1].append(b)
        return pa.table([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary())], ["a", "b"])

    links = placed.groupBy("t1", "t2").cogroup(carried.groupBy("u1", "u2")).applyInArrow(run, "a binary, b binary")
    return write_and_read(links, scratch_path(pairs.sparkSession, "near-links"))


def _tiles(nodes: DataFrame, leads: DataFrame) -> DataFrame:
    """``_key, tile``: the nodes of the leads; those of one best leader share tiles of about ``TILE_SHINGLES``."""
    best = leads.groupBy(F.col("b").alias("_key")).agg(F.max_by("a", F.struct("shared", "a")).alias("g"))
    leaders = leads.select(F.col("a").alias("_key")).distinct()
    grouped = leaders.join(best, "_key", "full").withColumn("g", F.coalesce("g", "_key")).join(nodes.select("_key", "n"), "_key")
    sizes = grouped.groupBy("g").agg(F.ceil(F.sum("n") / TILE_SHINGLES).alias("tiles"))
    chunk = F.pmod(F.xxhash64("_key"), F.greatest(F.lit(1), F.col("tiles")))
    return grouped.join(sizes, "g").select("_key", F.xxhash64("g", chunk).alias("tile"))


def _tile_links(table: pa.Table, weights: Weights, similarity: float) -> list[tuple[bytes, bytes]]:
    """Links that join components among the texts of two tiles: ``_key, label, sig, tile, _text``.

    A text is compared exactly with those (of the other tile, if there are
    two) whose samples agree enough and that no link found so far has joined
    with it.
    """
    keys, first = np.unique(np.array(table["_key"].to_pylist(), object), return_index=True)
    table = table.take(pa.array(first))
    names, label = np.unique(np.array(table["label"].to_pylist(), object), return_inverse=True)
    most = np.bincount(label).argmax()  # of two components, one isn't this one
    sig = np.frombuffer(b"".join(table["sig"].to_pylist()), "<u2").reshape(len(keys), -1)
    tile = np.asarray(table["tile"].combine_chunks(), np.int64)
    across = (tile != tile[0]).any()
    row, values, counts = shingles(table["_text"].combine_chunks())
    w = weights(values, counts)
    _, local = np.unique(values, return_inverse=True)
    at = np.searchsorted(row, np.arange(len(keys)))
    total = np.add.reduceat(w, at)  # every text here has shingles
    size = np.diff(np.append(at, len(row)))
    group = np.arange(len(names))[label]  # component of each text, as far as it has been joined
    out, own = [], np.zeros(int(local.max()) + 1)
    for i in np.flatnonzero(label != most):
        others = (group != group[i]) & (tile != tile[i]) if across else group != group[i]
        near = np.flatnonzero(others & ((sig == sig[i]).mean(1) >= ESTIMATE_FROM))
        if not len(near):
            continue
        mine = slice(at[i], at[i] + size[i])
        own[local[mine]] = w[mine]
        head = np.cumsum(size[near]) - size[near]
        places = np.arange(size[near].sum()) + np.repeat(at[near] - head, size[near])
        shared = np.add.reduceat(np.minimum(w[places], own[local[places]]), head)
        own[local[mine]] = 0
        for j in near[shared >= similarity * (total[near] + total[i] - shared)]:
            if group[j] != group[i]:
                group[group == group[j]] = group[i]
                out.append((keys[i], keys[j]))
    return out


def _verify_tiles(pairs: DataFrame, tiles: DataFrame, texts: DataFrame, weights: Weights, similarity: float) -> DataFrame:
    """Links between components from pairs of tiles ``t1, t2``; ``tiles`` has ``_key, label, sig, tile``."""
    needed = pairs.select("t1", "t2", F.explode(F.array("t1", "t2")).alias("tile")).distinct()
    carried = needed.join(tiles, "tile").join(texts, "_key").select("t1", "t2", "_key", "label", "sig", "tile", "_text")

    def run(table: pa.Table) -> pa.Table:
        links = _tile_links(table, weights, similarity)
        return pa.table([pa.array([a for a, _ in links], pa.binary()), pa.array([b for _, b in links], pa.binary())], ["a", "b"])

    links = carried.groupBy("t1", "t2").applyInArrow(run, "a binary, b binary")
    return write_and_read(links, scratch_path(pairs.sparkSession, "near-links"))


# -- candidates ----------------------------------------------------------------

def _leader_pairs(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """``a, b, shared``: every node and each leader of its buckets, with the number of buckets they share."""
    sized = members.join(sizes, "h")
    score = sized.groupBy("_key").agg(F.sum("c").alias("score"))
    leaders = members.join(score, "_key").groupBy("h").agg(F.max_by("_key", F.struct("score", "_key")).alias("leader"))
    pairs = members.join(leaders, "h").where(F.col("_key") != F.col("leader"))
    return pairs.groupBy(F.col("leader").alias("a"), F.col("_key").alias("b")).agg(F.count("*").alias("shared"))


def _open_tiles(members: DataFrame, nodes: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs of tiles ``t1, t2``, tiles ``_key, label, sig, tile``).

    A pair of tiles holds nodes that share a bucket, may be similar and aren't
    in one component.  Tiles hold the nodes of open buckets: those with the
    same largest one, about ``OPEN_SHINGLES`` at a time.  A group whose nodes
    all meet in some buckets so has few tiles, and of n shingles in it only
    n / ``OPEN_SHINGLES`` copies of each text are carried to pairs of tiles.
    """
    spark = members.sparkSession
    labelled = members.join(labels, "_key")
    split = (
        labelled.groupBy("h", "label").agg(F.count("*").alias("c"))
        .groupBy("h").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.sum("c").alias("size"), F.max("c").alias("most"))
        .where(F.col("most") < F.col("size"))
        .select(
            "h", "main", "size", F.ceil((F.col("size") - F.col("most")) / TILE_MEMBERS).cast("int").alias("rest_tiles"),
            F.ceil(F.col("size") / TILE_MEMBERS).cast("int").alias("all_tiles"),
        )
    )
    opened = write_and_read(
        labelled.join(split, "h").select(
            "h", "_key", "label", (F.col("label") != F.col("main")).alias("rest"), "size", "rest_tiles", "all_tiles"
        ),
        scratch_path(spark, "near-open"),
    )
    home = opened.groupBy("_key").agg(F.max(F.struct("size", "h")).alias("home"), F.first("label").alias("label"))
    home = home.join(nodes.select("_key", "n", "sig"), "_key").withColumn("home", F.col("home.h"))
    chunks = home.groupBy("home").agg(F.ceil(F.sum("n") / OPEN_SHINGLES).alias("chunks"))
    chunk = F.pmod(F.xxhash64("_key"), F.greatest(F.lit(1), F.col("chunks")))
    tiles = write_and_read(
        home.join(chunks, "home").select("_key", "label", "sig", F.xxhash64("home", chunk).alias("tile")),
        scratch_path(spark, "near-open-tiles"),
    )
    rows = opened.drop("label", "size").join(tiles, "_key")
    rows = write_and_read(rows, scratch_path(spark, "near-open-rows"))

    def own(count: str) -> Column:
        return F.pmod(F.xxhash64("_key"), F.col(count)).cast("int")

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    data = ["label", "sig", "tile"]
    rest = rows.where("rest").select("h", own("rest_tiles").alias("r"), each("all_tiles").alias("m"), *data)
    every = rows.select(F.col("h").alias("h2"), each("rest_tiles").alias("r2"), own("all_tiles").alias("m2"), *data)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = set()
        if left.num_rows and right.num_rows:
            sig = np.frombuffer(b"".join(right["sig"].to_pylist()), "<u2").reshape(right.num_rows, -1)
            tile = np.asarray(right["tile"].combine_chunks(), np.int64)
            number = {x: i for i, x in enumerate(sorted({*right["label"].to_pylist(), *left["label"].to_pylist()}))}
            label = np.array([number[x] for x in right["label"].to_pylist()])
            for raw, mine, at in zip(left["sig"].to_pylist(), left["label"].to_pylist(), left["tile"].to_pylist(), strict=True):
                alike = (sig == np.frombuffer(raw, "<u2")).mean(1) >= ESTIMATE_FROM
                for other in np.unique(tile[alike & (label != number[mine])]).tolist():
                    found.add((min(at, other), max(at, other)))
        pairs = sorted(found)
        return pa.table([pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())], ["t1", "t2"])

    tiled = rest.groupBy("h", "r", "m").cogroup(every.groupBy("h2", "r2", "m2"))
    pairs = tiled.applyInArrow(run, "t1 long, t2 long").distinct()
    return write_and_read(pairs, scratch_path(spark, "near-tile-pairs")), tiles


# -- the operator --------------------------------------------------------------

def _identified(docs: DataFrame, id_name: str = "_id", key_name: str = "_key") -> DataFrame:
    return docs.select(
        "*",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias(id_name),
        F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))).alias(key_name),
    )


def near_nodes(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(nodes ``_key, _id, copies, n, sig, bands``, ``_key, label`` of those that share a bucket).

    Nodes are distinct texts with the least id of their rows; nodes of a class
    have the same label.
    """
    spark = docs.sparkSession
    texts = _identified(docs.select("doc_id", "text")).select("_id", "_key", F.col("text").alias("_text"))
    weights = document_frequencies(texts, "_text")
    nodes = write_and_read(
        _signatures(texts, weights).groupBy("_key").agg(
            F.min("_id").alias("_id"), F.count("*").alias("copies"), F.first("n").alias("n"),
            F.first("sig").alias("sig"), F.first("bands").alias("bands"),
        ),
        scratch_path(spark, "near-nodes"),
    )
    buckets = nodes.where(F.col("n") > 0).select("_key", F.explode("bands").alias("h"))
    sizes = buckets.groupBy("h").agg(F.count("*").alias("c")).where(F.col("c") > 1)
    members = write_and_read(buckets.join(sizes, "h", "left_semi"), scratch_path(spark, "near-members"))
    sizes = members.groupBy("h").agg(F.count("*").alias("c"))
    leads = write_and_read(_leader_pairs(members, sizes), scratch_path(spark, "near-leads"))
    busy = members.select("_key").distinct().join(nodes.select("_key", "_id"), "_key")
    carried = write_and_read(
        texts.join(busy, ["_key", "_id"], "left_semi").select("_key", "_text"), scratch_path(spark, "near-texts")
    )
    tiles = write_and_read(_tiles(nodes, leads), scratch_path(spark, "near-tiles"))
    best = Window.partitionBy("b").orderBy(F.col("shared").desc(), "a")  # as many rows as bands at most
    first = leads.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= LEADERS).select("a", "b")
    labels = components(_verify(first, tiles, carried, weights, similarity))
    tiles = tiles.join(labels.select(F.col("node").alias("_key"), "label"), "_key", "left")
    tiles = write_and_read(tiles.withColumn("label", F.coalesce("label", "_key")), scratch_path(spark, "near-labels"))
    found = _verify_tiles(*_open_tiles(members, nodes, tiles.select("_key", "label")), carried, weights, similarity)
    # links between components: their labels are the nodes of a smaller graph
    named = found.join(tiles.select(F.col("_key").alias("a"), F.col("label").alias("la")), "a").join(
        tiles.select(F.col("_key").alias("b"), F.col("label").alias("lb")), "b"
    )
    joined = components(named.select(F.col("la").alias("a"), F.col("lb").alias("b")))
    last = tiles.select("_key", "label").join(
        joined.select(F.col("node").alias("label"), F.col("label").alias("into")), "label", "left"
    )
    return nodes, last.select("_key", F.coalesce("into", "label").alias("label"))


def near_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``_key, class_id, class_key, size`` by distinct text: the class's least (id, text hash) and its rows."""
    nodes, labels = near_nodes(docs, similarity)
    placed = nodes.select("_key", "_id", "copies").join(labels, "_key", "left").withColumn("label", F.coalesce("label", "_key"))
    heads = placed.groupBy("label").agg(F.min(F.struct("_id", "_key")).alias("head"), F.sum("copies").alias("size"))
    out = placed.join(heads, "label").select(
        "_key", F.col("head._id").alias("class_id"), F.col("head._key").alias("class_key"), "size"
    )
    return write_and_read(out, scratch_path(docs.sparkSession, "near-classes"))


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class (its least id), in the columns of ``docs``."""
    heads = near_classes(docs, similarity).where(F.col("_key") == F.col("class_key")).select(
        F.col("_key").alias("__key"), F.col("class_id").alias("__id")
    )
    ident = _identified(docs, "__id", "__key")
    kept = ident.join(heads, ["__key", "__id"], "left_semi").dropDuplicates(["__key", "__id"])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dup_digest(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Per document: its class (the least id in it), the class's number of rows, and whether it stands for it."""
    own = _identified(docs.select("doc_id", "text")).select("doc_id", "_id", "_key")
    found = own.join(near_classes(docs, similarity), "_key")
    return found.select(
        "doc_id",
        F.when(F.col("class_id") != _NO_ID, F.col("class_id")).alias("class_id"),
        F.col("size").alias("class_size"),
        ((F.col("_key") == F.col("class_key")) & (F.col("_id") == F.col("class_id"))).alias("kept"),
    )


ship_by_value(__name__)
