"""Explicit range bounds: chosen once, kept as a table, shared by runs and datasets.

Spark's own range partitioner samples its bounds anew in every job, so the id
of a range means nothing outside that job.  Here the bounds are a written
table of ``range_id, bound``; a bound is the comparable text
(:func:`sortproof.operators.ordering.sort_key`) of the last row of the range
below it.  Every row of every dataset finds its range by comparing its own
text with the bounds:

* up to ``INLINE_BOUNDS`` bounds are part of the expression, looked up by a
  binary search over a literal array: log2(bounds) comparisons per row;
* more bounds have two levels: every ``width``-th bound inline, which gives a
  cell, and the bounds of that cell (``width`` at most) from a table with one
  row per cell, joined on the cell.  100,000 ranges take 17 comparisons.

The rows then go straight to the partition with that number.  A key so
frequent that it fills several ranges has a repeated bound; its rows are dealt
over these ranges by their input partition, so a key with a third of all rows
does not fill one task, and the ranges in order are still the total order.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sortproof.operators.ordering import By, key_items, sort_key, with_order_columns
from sortproof.operators.sort import OFFSET_COL, RANGE_COL, order_spec, rank_records, sort_exprs, with_positions
from sortproof.session import scratch_path, write_and_read

#: Bounds that are searched as one literal array.
INLINE_BOUNDS = 1024
#: Sampled rows per range.
ROWS_PER_RANGE = 64


@dataclass(frozen=True)
class Splitters:
    """Bounds written at ``path``, and the order they are bounds of."""

    spark: SparkSession
    path: str
    key: object
    num_ranges: int
    tiebreak: bool = True
    java_string_order: bool = False

    @property
    def table(self) -> DataFrame:
        """``range_id, bound``: the last key of each range but the last one."""
        return self.spark.read.schema("range_id int, bound string").parquet(self.path)


def _order_text(key, tiebreak: bool, java_string_order: bool) -> str:
    parts = [[i.expression, i.ascending, i.nulls_last] if isinstance(i, By) else i for i in key_items(key)]
    return json.dumps([parts, tiebreak, java_string_order])


def _keyed(df: DataFrame, key, tiebreak: bool, java_string_order: bool) -> tuple[DataFrame, list, Column]:
    """(rows with the order's columns, its parts, its comparable text)."""
    keyed, plain = with_order_columns(df, key)
    spec = order_spec(plain, columns=[c for c in keyed.columns if c not in (RANGE_COL, OFFSET_COL)], tiebreak=tiebreak)
    return keyed, spec, sort_key(keyed, spec, java_string_order)


def choose_splitters(
    df: DataFrame, key, num_ranges: int, path: str, sample: bool = True, tiebreak: bool = True,
    java_string_order: bool = False, seed: int = 11,
) -> Splitters:
    """Write the bounds that cut ``df`` into ``num_ranges`` ranges of about the same number of rows.

    From about ``ROWS_PER_RANGE`` sampled rows per range, or, without
    ``sample``, from the exact ranks of all rows.  The sample is sorted like
    any table, so any number of ranges can be asked for.
    """
    if num_ranges < 1:
        raise ValueError("num_ranges must be positive")
    spark = df.sparkSession
    keyed, _, text = _keyed(df, key, tiebreak, java_string_order)
    keys = keyed.select(text.alias("bound"))
    if sample:
        share = min(1.0, num_ranges * ROWS_PER_RANGE / max(1, df.count()))
        keys = keys.sample(share, seed) if share < 1 else keys
    ranked = write_and_read(rank_records(keys, ["bound"]), scratch_path(spark, "splitter-ranks"))
    n = ranked.count()
    r, pos = F.lit(num_ranges), F.col("pos")
    # bound i stands at rank ceil(i n / r); a rank may be several of them
    last, first = F.expr(f"pos * {num_ranges} div {max(n, 1)}"), F.expr(f"(pos - 1) * {num_ranges} div {max(n, 1)} + 1")
    bounds = ranked.where(first <= last).select(F.explode(F.sequence(first, last)).alias("i"), "bound").where(F.col("i") < r)
    bounds = bounds.select((F.col("i") - 1).cast("int").alias("range_id"), "bound")
    write_and_read(bounds, path)
    about = json.dumps({"ranges": num_ranges, "order": _order_text(key, tiebreak, java_string_order)})
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/_about")
    return Splitters(spark, path, key, num_ranges, tiebreak, java_string_order)


def load_splitters(spark: SparkSession, path: str, key, tiebreak: bool = True, java_string_order: bool = False) -> Splitters:
    """Bounds written before; fails if they are bounds of another order."""
    about = json.loads(spark.read.text(f"{path}/_about").first()["value"])
    if about["order"] != _order_text(key, tiebreak, java_string_order):
        raise ValueError(f"the bounds at {path} are of another order: {about['order']}")
    return Splitters(spark, path, key, about["ranges"], tiebreak, java_string_order)


def _count_below(bounds: Column, most: int, key: Column, with_equal: bool) -> Column:
    """How many of the sorted ``bounds`` (``most`` at most) are below ``key``, or not above it: a binary search."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, most.bit_length())))])

    def search(k: Column) -> Column:
        def step(low: Column, width: Column) -> Column:
            bound = F.get(bounds, low + width - 1)  # null beyond the end
            return F.when((bound <= k) if with_equal else (bound < k), low + width).otherwise(low)

        return F.aggregate(steps, F.lit(0), step)

    return F.transform(F.array(key), search)[0]  # the key is computed once


def _with_counts(rows: DataFrame, splitters: Splitters, text: str, out: str, with_equal: bool) -> DataFrame:
    """``rows`` with the number of bounds below the text, or not above it."""
    n, table = splitters.num_ranges - 1, splitters.table
    if n <= INLINE_BOUNDS:
        bounds = [r["bound"] for r in table.orderBy("range_id").collect()]
        if not bounds:
            return rows.withColumn(out, F.lit(0))
        return rows.withColumn(out, _count_below(F.array(*map(F.lit, bounds)), len(bounds), F.col(text), with_equal))
    width = 1 << (n.bit_length() + 1) // 2
    coarse = [r["bound"] for r in table.where((F.col("range_id") + 1) % width == 0).orderBy("range_id").collect()]
    place = F.struct("range_id", "bound")
    cells = table.groupBy(F.expr(f"range_id div {width}").cast("int").alias("_cell")).agg(
        F.transform(F.array_sort(F.collect_list(place)), lambda x: x["bound"]).alias("_bounds")  # ``width`` at most
    )
    cell = _count_below(F.array(*map(F.lit, coarse)), len(coarse), F.col(text), with_equal)
    found = rows.withColumn("_cell", cell).join(F.broadcast(cells), "_cell", "left")  # as many bounds as ranges
    inside = F.coalesce(_count_below(F.col("_bounds"), width, F.col(text), with_equal), F.lit(0))
    return found.withColumn(out, F.col("_cell") * width + inside).drop("_cell", "_bounds")


def with_range_ids(df: DataFrame, splitters: Splitters) -> DataFrame:
    """``df`` with ``range_id``, the range of every row: the number of bounds below its key.

    Rows of a repeated bound are dealt over the ranges that it ends.
    """
    keyed, _, text = _keyed(df.drop(RANGE_COL), splitters.key, splitters.tiebreak, splitters.java_string_order)
    found = _with_counts(keyed.withColumn("_text", text), splitters, "_text", RANGE_COL, False)
    repeated = splitters.table.groupBy("bound").agg(F.count("*").alias("n")).where("n > 1")
    if not repeated.isEmpty():
        found = _with_counts(found, splitters, "_text", "_upto", True)
        spread = F.pmod(F.xxhash64(F.spark_partition_id()), F.greatest(F.lit(1), F.col("_upto") - F.col(RANGE_COL)))
        found = found.withColumn(RANGE_COL, F.col(RANGE_COL) + spread)
    own = [c for c in df.columns if c != RANGE_COL]
    return found.select(*[F.col(f"`{c}`") for c in own], F.col(RANGE_COL).cast("int").alias(RANGE_COL))


def split_sort(df: DataFrame, splitters: Splitters) -> DataFrame:
    """Rows in the partitions that the bounds give, sorted inside; ``range_id`` is the partition's number."""
    keyed, spec, _ = _keyed(with_range_ids(df, splitters), splitters.key, splitters.tiebreak, splitters.java_string_order)
    exprs = sort_exprs(keyed, spec, splitters.java_string_order)
    placed = keyed.repartitionById(splitters.num_ranges, F.col(RANGE_COL)).sortWithinPartitions(*exprs)
    return placed.select(*[F.col(f"`{c}`") for c in df.columns if c != RANGE_COL], RANGE_COL)


def write_split(df: DataFrame, splitters: Splitters, path: str) -> DataFrame:
    """A sorted table like ``write_sorted``'s, cut at the kept bounds; returned read back."""
    return write_and_read(with_positions(split_sort(df, splitters)), path)
