"""Mixing sources to target weights, with DataFrame functions only.

Method: every document gets a hash-random key; within each source the key
space is cut into ranges and each range is sorted; word counts are summed per
range, prefix-summed over the ranges and then inside each range; the order so
laid out is cut at the source's exact budget.  A budget above the source's
size takes the source in whole epochs first and cuts the last one.

* Targets: sources in code point order (null last) weigh 1, 2, 3, 1, 2, 3, ...
  and share ``share`` of all words; no target is above ``max_epochs`` times
  its source, the excess goes to the other sources by weight.  The fixed point
  of that resharing is found in closed form: sources sorted by
  (cap / weight), the first one whose cap its share doesn't reach sets the
  level for all later ones.  These windows run over one row per source.
* A hot source is spread over ``ranges`` key ranges; no window or join key
  ever holds a whole source.  The only join is on (source, range), on which
  the large side is already partitioned for its window.

Cases: null or empty texts have size 0 and take 0; null sources form one
source, last in order; rows with equal ids and texts are told apart by row
number in their range, each of them taken like any other document; a table
without words has targets 0; an empty table gives an empty table; extra
columns stay untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sortproof.llm.columns import word_count

#: Documents of one source and key range are sorted in one window partition.
RANGES = 1024
SEED = 20_011
# Weights of the sources, in order, repeating.
WEIGHTS = (1.0, 2.0, 3.0)


def source_targets(sizes: DataFrame, share: float = 1.0, max_epochs: float = 3.0) -> DataFrame:
    """One row per source with ``target`` words, from rows ``_sn, _sv, source_size``."""
    in_order = Window.orderBy("_sn", "_sv")
    by_ratio = Window.orderBy("ratio", "_sn", "_sv")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy()
    weight = F.get(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(in_order) - 1) % len(WEIGHTS))
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    return (
        sizes.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everywhere) * F.lit(float(share)))
        .withColumn("weights", F.sum("weight").over(everywhere))
        .withColumn("level", level)
        .withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn(
            "final", F.min_by("level", F.when(F.col("open"), F.struct("ratio", "_sn", "_sv"))).over(everywhere)
        )
        .select(
            "_sn", "_sv", "source_size",
            F.least("cap", F.coalesce(F.col("final") * F.col("weight"), F.col("cap"))).alias("target"),
        )
    )


def _keyed(docs: DataFrame, ranges: int, seed: int) -> DataFrame:
    """Identity, size and hash-random key of every document; no texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), text)
    return docs.select(
        "doc_id",
        F.xxhash64(text).alias("_t"),
        F.col("source").isNull().alias("_sn"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_sv"),
        word_count(F.col("text")).alias("size"),
        key.alias("_key"),
    ).withColumn("_range", F.floor((F.col("_key") / F.lit(2.0**64) + 0.5) * ranges).cast("int"))


def mix(
    docs: DataFrame, share: float = 1.0, max_epochs: float = 3.0, ranges: int = RANGES, seed: int = SEED,
    keep_source: bool = False,
) -> DataFrame:
    """``doc_id, _t, size, source_size, target, taken`` for every document.

    ``taken`` counts the words that the mix takes from the document, repeats
    included; it adds up to the source's target rounded to whole words.
    """
    keyed = _keyed(docs, ranges, seed)
    per_range = keyed.groupBy("_sn", "_sv", "_range").agg(F.sum("size").alias("range_size"))
    targets = source_targets(
        per_range.groupBy("_sn", "_sv").agg(F.sum("range_size").alias("source_size")), share, max_epochs
    )
    earlier = Window.partitionBy("_sn", "_sv").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_range.select(
        "_sn", "_sv", "_range", F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("range_start")
    ).join(targets, ["_sn", "_sv"])
    inside = (
        Window.partitionBy("_sn", "_sv", "_range")
        .orderBy("_key", "doc_id", "_t")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = keyed.withColumn("_end", F.sum("size").over(inside)).join(starts, ["_sn", "_sv", "_range"])
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    start = F.col("range_start") + F.col("_end") - F.col("size")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), rest - start))
    return placed.select(
        "doc_id", "_t", *(["_sn", "_sv"] if keep_source else []), "size", "source_size", "target",
        (epochs * F.col("size") + F.coalesce(cut, F.lit(0))).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, share: float = 1.0, max_epochs: float = 3.0) -> DataFrame:
    """The mix itself: each document as often as it is taken, in the columns of ``docs``.

    The document at a source's cut is kept whole, so a source exceeds its
    target by less than that document's size.  Documents without words are
    no part of any mix and stay as they are, once.  Rows of equal id, text and
    source are one document with a count: the mix takes as many of them as it
    takes rows, all as the first one's columns.
    """
    identity = {
        "__id_null": F.col("doc_id").isNull(), "__id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        "__t": F.xxhash64(F.coalesce(F.col("text"), F.lit(""))),
        "__sn": F.col("source").isNull(), "__sv": F.coalesce(F.col("source").cast("string"), F.lit("")),
    }
    taken = mix(docs.select("doc_id", "text", "source"), share, max_epochs, keep_source=True)
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.ceil(F.col("taken") / F.col("size"))).cast("int")
    copies = (  # a row per copy, without its text
        taken.select(
            F.col("doc_id").isNull().alias("__id_null"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id"),
            F.col("_t").alias("__t"), F.col("_sn").alias("__sn"), F.col("_sv").alias("__sv"), times.alias("__times"),
        )
        .where(F.col("__times") > 0)
        .withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    )
    once = docs.withColumns(identity).dropDuplicates(list(identity))  # a row per document, on the keys of the join
    return copies.join(once, list(identity)).select(*[F.col(f"`{c}`") for c in docs.columns])


def mixing_digest(docs: DataFrame) -> DataFrame:
    """The operator's figures per document."""
    return mix(docs.select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )
