"""Short codes for vectors: integer product quantisation, assigned along a lexicographic trie.

A component x becomes the integer floor(1024 x); a vector is cut into ``PARTS``
equal parts, and each part's code is the index of the nearest of ``ENTRIES``
codebook entries (squared Euclidean distance, ties to the lower index).
Everything is exact integer arithmetic, so results don't depend on the order
of rows, tasks or retries.

1. The distinct parts of each position are counted (equal vectors collapse
   before the shuffle) and range-sorted, so a task holds a lexicographic run.
2. A sorted run is a trie: parts with the same first dimensions share a path.
   A depth-first walk carries, per entry, the distance over the dimensions so
   far, adds a dimension once per node and not once per part, and takes the
   argmin in the leaves.  Subtrees of up to ``LEAVES`` parts are walked level by
   level as matrices, a row per node and a column per entry.
3. Leaves add count times part to the sums of their entry.  A task gives one
   row per position and entry (``PARTS * ENTRIES`` at most), Spark sums them,
   and the driver gets only those sums: ``ENTRIES`` * dimension numbers.
4. After ``ROUNDS`` rounds the rows are coded along tries of their own parts.

Each codebook begins with the parts of the ``ENTRIES`` smallest ids (fewer if
there are fewer).  Vectors of different dimensions have codebooks of their own.

Cases: vectors that are null, or hold null or non-finite components, take no
part, nor do those that can't be cut into equal parts (dimension 0 or no
multiple of ``PARTS``) or with components so large that a squared distance may
not fit a long (beyond ``largest``: about 190,000 in 64 dimensions).  Rows
without an id are coded but begin no entry; an id that is repeated begins one
entry, with its least vector; equal rows each count; null labels are one label;
an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sortproof._pickling import ship_by_value
from sortproof.session import scratch_path, write_and_read

PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Integer steps of a component of 1.
STEPS = 1024
#: Parts of a subtree that is walked level by level.
LEAVES = 512


# -- tries ---------------------------------------------------------------------

def distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows in lexicographic order, the place of each row among them)."""
    order = np.lexsort(rows.T[::-1])
    own = rows[order]
    new = np.append(True, (own[1:] != own[:-1]).any(1))[: len(own)]
    place = np.empty(len(rows), np.int64)
    place[order] = np.cumsum(new) - 1
    return own[new], place


def nearest_entries(parts: np.ndarray, book: np.ndarray, leaves: int = LEAVES) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry of each of ``parts``, distinct and in lexicographic order."""
    n, width = parts.shape
    code, error = np.empty(n, np.int64), np.empty(n, np.int64)
    stack = [(0, n, 0, np.zeros(len(book), np.int64))] if n else []
    while stack:
        low, high, depth, so_far = stack.pop()
        if high - low <= leaves or depth == width:
            _walk_levels(parts[low:high], book, depth, so_far, code[low:high], error[low:high])
            continue
        column = parts[low:high, depth]
        heads = low + np.flatnonzero(np.append(True, column[1:] != column[:-1]))
        ends = np.append(heads[1:], high)
        todo, at = [], 0
        while at < len(heads):
            if ends[at] - heads[at] > leaves:  # a child of its own
                step = parts[heads[at], depth] - book[:, depth]
                todo.append((heads[at], ends[at], depth + 1, so_far + step * step))
                at += 1
                continue
            to = at + 1  # small children side by side
            while to < len(heads) and ends[to] - heads[at] <= leaves:
                to += 1
            todo.append((heads[at], ends[to - 1], depth, so_far))
            at = to
        stack += reversed(todo)
    return code, error


def _walk_levels(parts: np.ndarray, book: np.ndarray, depth: int, so_far: np.ndarray, code: np.ndarray, error: np.ndarray) -> None:
    """Fill in code and error of a small subtree below a node with the distances ``so_far``."""
    new = np.zeros(len(parts), bool)
    new[0] = True
    node = np.zeros(1, np.int64)  # first row of each node of the level
    reached = so_far[None, :]
    for d in range(depth, parts.shape[1]):
        if len(node) < len(parts):
            before = np.cumsum(new) - 1
            new[1:] |= parts[1:, d] != parts[:-1, d]
            node = np.flatnonzero(new)
            reached = reached[before[node]]
        step = parts[node, d, None] - book[None, :, d]
        step *= step
        reached = reached + step
    best = reached.argmin(1)
    code[:], error[:] = best, reached[np.arange(len(reached)), best]


# -- vectors -------------------------------------------------------------------

def largest(dimension: int) -> int:
    """Greatest size of an integer component for which all squared distances fit a long."""
    return math.isqrt((2**63 - 1) // (4 * dimension))


def _integers(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, integer vectors) of the rows that take part, one pair per dimension."""
    lists = batch.column("embedding")
    lengths = np.asarray(lists.value_lengths().fill_null(0), np.int64)
    for dim in np.unique(lengths[(lengths > 0) & (lengths % PARTS == 0)]).tolist():
        rows = np.flatnonzero(lengths == dim)
        values = lists.take(pa.array(rows)).flatten().cast(pa.float64())
        wide = np.floor(np.asarray(values.fill_null(np.nan), np.float64).reshape(-1, dim) * STEPS)
        fit = (np.abs(wide) <= largest(dim)).all(1)  # false for NaN
        if fit.any():
            yield rows[fit], wide[fit].astype(np.int64)


def _lists(wide: np.ndarray) -> pa.Array:
    bounds = pa.array(np.arange(len(wide) + 1) * wide.shape[1], pa.int32())
    return pa.ListArray.from_arrays(bounds, pa.array(wide.astype(np.int32).ravel()))


def _wide(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1)


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, dim, v`` of the rows that take part."""
    label = vectors.schema["label"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, wide in _integers(batch):
                own = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [own.column("vec_id"), own.column("label"), pa.array(np.full(len(rows), wide.shape[1], np.int32)), _lists(wide)],
                    ["vec_id", "label", "dim", "v"],
                )

    schema = T.StructType().add("vec_id", T.LongType()).add("label", label).add("dim", T.IntegerType()).add("v", T.ArrayType(T.IntegerType()))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").mapInArrow(run, schema)


# -- codebooks -----------------------------------------------------------------

@dataclass
class Codebooks:
    """Entries of each part position, in one dimension of vectors."""

    dimension: int
    books: list[np.ndarray]

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for b in self.books for x in b.ravel().tolist()).encode()).hexdigest()


def _first_books(rows: DataFrame, dim: int, entries: int) -> list[np.ndarray]:
    ids = [r[0] for r in rows.select("vec_id").where(F.col("vec_id").isNotNull()).distinct().orderBy("vec_id").limit(entries).collect()]
    if not ids:
        return [np.zeros((1, dim // PARTS), np.int64) for _ in range(PARTS)]  # no id at all: one entry of zeros
    head = rows.where(F.col("vec_id") <= ids[-1]).groupBy("vec_id").agg(F.min("v").alias("v"))
    wide = np.array([r["v"] for r in head.orderBy("vec_id").collect()], np.int64)  # ``entries`` vectors
    return [p.copy() for p in np.split(wide, PARTS, axis=1)]


def _distinct_parts(rows: DataFrame, dim: int) -> DataFrame:
    """``part, x, n``: the distinct parts of each position and how often they occur, in lexicographic runs."""
    width = dim // PARTS
    cut = [F.struct(F.lit(j).alias("part"), F.slice("v", j * width + 1, width).alias("x")) for j in range(PARTS)]
    parts = rows.select(F.explode(F.array(*cut)).alias("p")).groupBy(F.col("p.part").alias("part"), F.col("p.x").alias("x"))
    counted = write_and_read(parts.agg(F.count("*").alias("n")), scratch_path(rows.sparkSession, "code-parts"))
    runs = counted.repartitionByRange("part", "x").sortWithinPartitions("part", "x")
    return write_and_read(runs, scratch_path(rows.sparkSession, "code-runs"))


def _sums(parts: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``part, entry, n, s0, s1, ...``: what the entries' parts add up to."""
    width = books[0].shape[1]
    names = [f"s{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [np.zeros(len(b), np.int64) for b in books]
        total = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            position, x, n = np.asarray(batch.column("part")), _wide(batch.column("x")), np.asarray(batch.column("n"))
            for j in np.unique(position).tolist():
                at = np.flatnonzero(position == j)
                own, place = distinct_rows(x[at])  # in order already, whatever the files' batches
                times = np.zeros(len(own), np.int64)
                np.add.at(times, place, n[at])
                code, _ = nearest_entries(own, books[j])
                np.add.at(count[j], code, times)
                np.add.at(total[j], code, own * times[:, None])
        for j, n in enumerate(count):
            used = np.flatnonzero(n)
            if len(used):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), j, np.int32)), pa.array(used.astype(np.int32)), pa.array(n[used]), *map(pa.array, total[j][used].T)],
                    ["part", "entry", "n", *names],
                )

    found = parts.mapInArrow(run, "part int, entry int, n long, " + ", ".join(f"{s} long" for s in names))
    return found.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *names)])


def train_codebooks(rows: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[Codebooks]:
    """Codebooks of each dimension among ``rows`` (as :func:`integer_vectors` gives them)."""
    out = []
    for dim in sorted(r["dim"] for r in rows.select("dim").distinct().collect()):
        own = rows.where(F.col("dim") == dim)
        books = _first_books(own, dim, entries)
        parts = _distinct_parts(own, dim)
        for _ in range(rounds):
            for r in _sums(parts, books).collect():  # a row per part and entry
                books[r["part"]][r["entry"]] = [s // r["n"] for s in r[3:]]
        out.append(Codebooks(dim, books))
    return out


def encode_vectors(rows: DataFrame, codebooks: list[Codebooks]) -> DataFrame:
    """``vec_id, label, dim, code, error``: a byte per part, and the squared distance to what the code stands for."""
    books = {c.dimension: c.books for c in codebooks}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims).tolist():
                own = batch.take(pa.array(np.flatnonzero(dims == dim)))
                codes, error = np.empty((own.num_rows, PARTS), np.uint8), np.zeros(own.num_rows, np.int64)
                for j, x in enumerate(np.split(_wide(own.column("v")), PARTS, axis=1)):
                    parts, place = distinct_rows(x)
                    code, distance = nearest_entries(parts, books[dim][j])
                    codes[:, j] = code[place]
                    error += distance[place]
                raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(PARTS), len(codes), [None, pa.py_buffer(codes.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [own.column("vec_id"), own.column("label"), own.column("dim"), raw.cast(pa.binary()), pa.array(error)],
                    ["vec_id", "label", "dim", "code", "error"],
                )

    schema = T.StructType(rows.schema.fields[:3]).add("code", T.BinaryType()).add("error", T.LongType())
    return rows.select("vec_id", "label", "dim", "v").mapInArrow(run, schema)


def vector_codes_digest(embeddings: DataFrame) -> DataFrame:
    """Codes of all vectors, the error of each and of its label, and a hash of the codebooks."""
    spark = embeddings.sparkSession
    rows = write_and_read(integer_vectors(embeddings), scratch_path(spark, "code-rows"))
    codebooks = train_codebooks(rows)
    coded = write_and_read(encode_vectors(rows, codebooks), scratch_path(spark, "codes"))
    labels = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_l")
    sha = F.lit(None).cast("string")
    for c in codebooks:
        sha = F.when(F.col("dim") == c.dimension, F.lit(c.sha256)).otherwise(sha)
    return coded.join(labels, F.col("label").eqNullSafe(F.col("_l"))).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", sha.alias("codebooks_sha256")
    )


def _codes_sql() -> str:
    """All of it in SQL, for vectors of one dimension and distinct ids: a block of tables per round."""
    step = ["""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, len(embedding) // 4 AS w,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c AS MATERIALIZED (
  SELECT rid, vec_id, i // w AS part, i % w AS i, v[i + 1] AS x FROM k, unnest(range(4 * w)) AS t(i)
), b0 AS MATERIALIZED (
  SELECT part, e, i, x FROM c JOIN (SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k ORDER BY vec_id LIMIT 256) USING (rid)
)"""]
    for r in range(ROUNDS + 1):
        step.append(f"""
, a{r} AS MATERIALIZED (
  SELECT rid, part, min(struct_pack(d := d, e := e)) AS m
  FROM (SELECT c.rid, c.part, b.e, sum((c.x - b.x) * (c.x - b.x)) AS d FROM c JOIN b{r} b ON c.part = b.part AND c.i = b.i GROUP BY ALL)
  GROUP BY ALL
)""")
        if r < ROUNDS:
            step.append(f"""
, s{r} AS (
  SELECT c.part, a.m.e AS e, c.i, sum(c.x) AS s, count(*) AS n FROM c JOIN a{r} a ON a.rid = c.rid AND a.part = c.part GROUP BY ALL
), b{r + 1} AS MATERIALIZED (
  SELECT b.part, b.e, b.i, CAST(CASE WHEN s.n IS NULL THEN b.x ELSE (s.s - ((s.s % s.n) + s.n) % s.n) // s.n END AS BIGINT) AS x
  FROM b{r} b LEFT JOIN s{r} s ON s.part = b.part AND s.e = b.e AND s.i = b.i
)""")
    return "".join(step) + f"""
, o AS (
  SELECT rid, string_agg(lower(printf('%02x', CAST(m.e AS BIGINT))), '' ORDER BY part) AS code, CAST(sum(m.d) AS BIGINT) AS error
  FROM a{ROUNDS} GROUP BY rid
)
SELECT k.vec_id, o.code, o.error, CAST(sum(o.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, e, i)) FROM b{ROUNDS}) AS codebooks_sha256
FROM k JOIN o USING (rid)"""


VECTOR_CODES_SQL = _codes_sql()

ship_by_value(__name__)
