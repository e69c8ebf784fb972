"""How far apart the sources of a language are: Gustavson row accumulation over a term-major index.

A group is a (lang, source).  Terms are runs of letters (ASCII letters and all
characters from U+0080), A-Z lower-cased; a language keeps the terms found in
``MIN_DOCUMENTS`` of its documents.  A group gives a kept term the smoothed
share ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))`` and two shares differ by
``f(p, q) = floor((p - q)^2 / (p + q))``.  Everything is integer arithmetic.

1. Tasks count the terms of whole texts, a block of text at a time, so that one
   row per (group, term) and block reaches Spark's partial sums.  Terms are
   told apart by their bytes, not by a hash.
2. The counts of the kept terms are the index: postings (term, group, share),
   of which only those above zero exist.
3. The distance of two groups is the product of a sparse matrix with its own
   transpose under ``f``.  It is worked out in Gustavson's order: a task holds a
   block of the index by term; each group's row scatters its terms through the
   postings into a dense accumulator with a place per peer.  No pair of
   postings is emitted: a task gives one partial sum per pair of groups.
4. Groups without a term still give it a share, the group's zero baseline.  So an
   accumulator begins with all terms at both baselines, a group's terms are
   then moved against the baselines of all peers by the histogram of its
   shares, the same for the peers' terms, and what is scattered for a shared
   term is the difference that remains.

A language's index is cut into blocks of about a quarter of its pairs of groups
(``BLOCK_POSTINGS`` at least, ``MOST_POSTINGS`` at most), so partial sums stay a
few times the postings; rows of a block are dealt over several tasks where
there are many groups.  A hot source is one column of numbers per block and a
hot term one posting per source; neither gathers in a task.

Cases: null text, lang and source count as empty; a text without terms makes
its group occur; a language without kept terms has distances of 0 and no
terms; equal rows count as often as they occur; ties go by the item's UTF-8
bytes; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sortproof._pickling import ship_by_value
from sortproof.llm.utf8 import blocks, flat, word_spans
from sortproof.session import scratch_path, write_and_read

MIN_DOCUMENTS = 10
TOP_TERMS = 10
#: Bytes of text counted at once, about.
COUNTED_BYTES = 8_000_000
BLOCK_POSTINGS = 1 << 14
MOST_POSTINGS = 1 << 22
#: Pairs of groups that leave a task, about.
TASK_PAIRS = 1 << 21

# The bytes that stand between terms, U+0000-U+0040, U+005B-U+0060, U+007B-U+007F.
_APART = np.zeros(256, bool)
_APART[0x00:0x41] = _APART[0x5B:0x61] = _APART[0x7B:0x80] = True
_SCALE = 1_000_000_000

_COUNTS = "lang string, source string, term string, n long, docs long"


# -- counting ------------------------------------------------------------------

def term_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(text, code) of every occurrence of a term, and the terms by code."""
    data, offsets = flat(texts)
    starts, ends, first = word_spans(data, offsets, _APART)
    upper = (data >= 0x41) & (data <= 0x5A)
    letters = np.where(upper, data | 0x20, data)[~_APART[data]]
    at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    column = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(letters)])
    coded = column.dictionary_encode()
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    return text, coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.large_string())


def _codes(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = column.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch, "text", COUNTED_BYTES):
            text, code, terms = term_codes(block.column("text"))
            if not len(text):
                continue
            lang, langs = _codes(block.column("lang"))
            source, sources = _codes(block.column("source"))
            group, width = lang * len(sources) + source, len(terms)
            keys, n = np.unique(group[text] * width + code, return_counts=True)
            once = np.unique(text * width + code)  # a term of a text
            _, docs = np.unique(group[once // width] * width + once % width, return_counts=True)  # the same keys
            of, term = keys // width, keys % width
            yield pa.RecordBatch.from_arrays(
                [
                    langs.take(pa.array(of // len(sources))).cast(pa.string()), sources.take(pa.array(of % len(sources))).cast(pa.string()),
                    terms.take(pa.array(term)).cast(pa.string()), pa.array(n.astype(np.int64)), pa.array(docs.astype(np.int64)),
                ],
                ["lang", "source", "term", "n", "docs"],
            )


def _share(count: str, total: str) -> Column:
    """p of a count; ``total`` is N + 2 V.  Decimals: 10^9 times a count may not fit a long."""
    return F.expr(f"1 + (CAST({count} + 2 AS DECIMAL(20,0)) * {_SCALE}BD) div CAST(nullif({total}, 0) AS DECIMAL(20,0))")


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """f(p, q), exact for shares up to 10^9 + 1."""
    return (p - q) * (p - q) // (p + q)


def index_of(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """(postings ``lang, source, term, p, q``, groups ``lang, source, p0, terms, postings, peers``).

    p is a group's share of a term and q the whole language's; p0 the group's
    share of a term that it hasn't (null if the language keeps none).
    ``terms``, ``postings`` and ``peers`` count the language's kept terms,
    postings and groups.
    """
    spark = docs.sparkSession
    named = [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]
    parts = docs.select(*named, F.col("text").alias("text")).mapInArrow(_count, _COUNTS)
    counts = parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = write_and_read(counts, scratch_path(spark, "audit-counts"))
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("whole")).where(
        F.col("docs") >= min_documents
    )
    found = counts.join(kept.select("lang", "term", "whole"), ["lang", "term"])
    found = write_and_read(found.select("lang", "source", "term", "n", "whole"), scratch_path(spark, "audit-kept"))

    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("whole").alias("lang_n"))
    used = found.groupBy("lang", "source").agg(F.sum("n").alias("group_n"), F.count("*").alias("own"))
    groups = docs.select(*named).distinct().join(used, ["lang", "source"], "left").na.fill(0, ["group_n", "own"])
    sizes = groups.groupBy("lang").agg(F.sum("own").alias("postings"), F.count("*").alias("peers"))
    groups = groups.join(sizes, "lang").join(langs, "lang", "left").na.fill(0, ["terms", "lang_n"]).select(
        "lang", "source", "terms", "postings", "peers", (F.col("group_n") + 2 * F.col("terms")).alias("own_total"),
        (F.col("lang_n") + 2 * F.col("terms")).alias("lang_total"),
    ).withColumn("p0", _share("0", "own_total"))
    groups = write_and_read(groups, scratch_path(spark, "audit-groups"))
    totals = groups.select("lang", "source", "own_total", "lang_total")
    postings = found.join(totals, ["lang", "source"]).select(
        "lang", "source", "term", _share("n", "own_total").alias("p"), _share("whole", "lang_total").alias("q")
    )
    return write_and_read(postings, scratch_path(spark, "audit-postings")), groups


# -- rows through the index ------------------------------------------------------

def accumulated(term: np.ndarray, group: np.ndarray, share: np.ndarray, zero: np.ndarray, rows: np.ndarray) -> Iterator[np.ndarray]:
    """For each of ``rows`` the distances to all groups, over the terms of these postings.

    Postings are (term, group, share) with terms and groups as numbers from 0;
    ``zero`` has the share that each group gives a term it hasn't.
    """
    width = int(term.max()) + 1 if len(term) else 0
    by_term = np.argsort(term, kind="stable")
    peer, q = group[by_term], share[by_term]
    first = np.searchsorted(term[by_term], np.arange(width + 1))
    by_group = np.argsort(group, kind="stable")
    begin = np.searchsorted(group[by_group], np.arange(len(zero) + 1))
    # how often a group gives a share: terms aren't told apart where the other side is at its baseline
    order = np.lexsort((share, group))
    head = np.flatnonzero(np.append(True, (np.diff(group[order]) != 0) | (np.diff(share[order]) != 0))[: len(order)])
    of, level, times = group[order][head], share[order][head], np.diff(np.append(head, len(order)))
    levels = np.searchsorted(of, np.arange(len(zero) + 1))
    for i in rows:
        base = difference(zero[i], zero)
        total = width * base
        # the peers' terms against this row's baseline, this row's against the peers'
        np.add.at(total, of, times * (difference(zero[i], level) - base[of]))
        step = max(1, (1 << 20) // max(1, len(zero)))
        for a in range(levels[i], levels[i + 1], step):
            some = slice(a, min(a + step, levels[i + 1]))
            total += (times[some, None] * (difference(level[some, None], zero) - base)).sum(0)
        # shared terms, through their postings
        mine = by_group[begin[i] : begin[i + 1]]
        size = first[term[mine] + 1] - first[term[mine]]
        at = np.arange(size.sum()) + np.repeat(first[term[mine]] - (np.cumsum(size) - size), size)
        p, other = np.repeat(share[mine], size), peer[at]
        np.add.at(total, other, difference(p, q[at]) - difference(p, zero[other]) - difference(zero[i], q[at]) + base[other])
        yield total


def _distances(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, a, b, value`` of every two groups of a language, a before b."""
    most = F.greatest(F.lit(BLOCK_POSTINGS), F.least(F.lit(MOST_POSTINGS), F.col("peers") * F.col("peers") / 4))
    sizes = groups.select("lang", "postings", "peers").distinct().select(
        "lang", F.greatest(F.lit(1), F.ceil(F.col("postings") / most)).cast("int").alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("peers") * F.col("peers") / TASK_PAIRS)).cast("int").alias("strides"),
    )

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    dealt = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    left = postings.join(sizes, "lang").select("lang", dealt, each("strides").alias("stride"), "term", "source", "p")
    right = groups.join(sizes, "lang").withColumn("block", each("blocks")).select(
        "lang", "block", each("strides").alias("stride"), "strides", "source", "p0"
    )

    def run(own: pa.Table, peers: pa.Table) -> pa.Table:
        peers = peers.sort_by("source")
        names = peers["source"].combine_chunks()
        place = {s: i for i, s in enumerate(names.to_pylist())}
        zero = np.asarray(peers["p0"].fill_null(1), np.int64)
        term, _ = _codes(own["term"].combine_chunks())
        group = np.array([place[s] for s in own["source"].to_pylist()], np.int64)
        rows = np.arange(peers["stride"][0].as_py(), len(zero), peers["strides"][0].as_py())
        a, b, value = [], [], []
        for i, total in zip(rows, accumulated(term, group, np.asarray(own["p"], np.int64), zero, rows), strict=True):
            a.append(np.full(len(zero) - i - 1, i))
            b.append(np.arange(i + 1, len(zero)))
            value.append(total[i + 1 :])
        first, second, sums = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (a, b, value))
        lang = pa.array([peers["lang"][0].as_py()] * len(sums), pa.string())
        return pa.table([lang, names.take(pa.array(first)), names.take(pa.array(second)), pa.array(sums)], ["lang", "a", "b", "value"])

    keys = ["lang", "block", "stride"]
    parts = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "lang string, a string, b string, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence_audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: the other sources of the language by distance, farthest
    first.  Part ``term``: the ``top_terms`` terms that a source has more than
    its language, by their difference.
    """
    postings, groups = index_of(docs, min_documents)
    both = F.explode(F.array(F.struct(F.col("a").alias("s"), F.col("b").alias("i")), F.struct(F.col("b").alias("s"), F.col("a").alias("i"))))
    pairs = _distances(postings, groups).select("lang", both.alias("x"), "value").select(
        "lang", F.col("x.s").alias("source"), F.lit("pair").alias("part"), F.col("x.i").alias("item"), "value"
    )
    terms = postings.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(order)
    return pairs.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).where(F.col("rank") <= top_terms))


_F = "((p - q) * (p - q)) // (p + q)"
DIVERGENCE_AUDIT_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), o AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), c AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT rid) AS docs FROM o GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= {MIN_DOCUMENTS}
), v AS (
  SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang
), g AS (
  SELECT DISTINCT lang, source FROM d
), k AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, kept.n AS whole
  FROM g JOIN kept ON g.lang = kept.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
), t AS (
  SELECT lang, source, sum(n) AS n FROM k GROUP BY ALL
), s AS (
  SELECT k.lang, k.source, term, k.n, 1 + ({_SCALE}::HUGEINT * (k.n + 2)) // (t.n + 2 * v.v) AS p,
         1 + ({_SCALE}::HUGEINT * (k.whole + 2)) // (v.n + 2 * v.v) AS q
  FROM k JOIN t ON k.lang = t.lang AND k.source = t.source JOIN v ON k.lang = v.lang
), f AS (
  SELECT lang, source, item, CAST(sum({_F}) AS BIGINT) AS value
  FROM (SELECT a.lang, a.source, b.source AS item, a.p, b.p AS q
        FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source) GROUP BY ALL
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST({_F} AS BIGINT) FROM s WHERE n > 0 AND p > q
), x AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r
)
SELECT lang, source, part, item, value, rank FROM x WHERE part = 'pair' OR rank <= {TOP_TERMS}"""


ship_by_value(__name__)
