"""Merge of tables that are sorted already, without moving what needs no merging.

A sorted table is a set of files, each sorted inside.  The least and greatest
key of every file (one row per file) tell which files overlap.  A file that
overlaps no other is a stretch of the result as it stands: its rows get their
rank from the rows before the file and their place in it, and are not
shuffled.  Only rows of overlapping files go through a range sort.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sortproof.operators.ordering import key_items, sort_key, with_order_columns
from sortproof.operators.sort import OFFSET_COL, RANGE_COL, empty_records, order_spec, rank_records
from sortproof.session import scratch_path, write_and_read

#: With so many files at most, the table of files is broadcast.
BROADCAST_FILES = 100_000


def file_stretches(rows: DataFrame, key_text) -> DataFrame:
    """``_file, stretch, alone, before``: files in key order, numbered by stretches of overlapping ones.

    ``rows`` has ``_file``.  ``alone`` says that a file overlaps no other;
    ``before`` is the number of rows in earlier stretches.  Files that touch
    in equal keys don't overlap: equal keys may stand in any order.
    """
    files = rows.select("_file", key_text.alias("_k")).groupBy("_file").agg(
        F.min("_k").alias("lo"), F.max("_k").alias("hi"), F.count("*").alias("n")
    )
    order = Window.orderBy("lo", "hi", "_file")  # a row per file
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    starts = F.coalesce(F.col("lo") >= F.max("hi").over(earlier), F.lit(True)).cast("int")
    numbered = files.withColumn("_starts", starts).withColumn("stretch", F.sum("_starts").over(order))
    stretches = numbered.groupBy("stretch").agg(F.sum("n").alias("rows"), F.count("*").alias("files"))
    in_order = Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stretches.select(
        "stretch", (F.col("files") == 1).alias("alone"),
        F.coalesce(F.sum("rows").over(in_order), F.lit(0)).alias("before"),
        F.coalesce(F.sum(F.when(F.col("files") == 1, F.col("rows")).otherwise(0)).over(in_order), F.lit(0)).alias("alone_before"),
    )
    return numbered.select("_file", "stretch").join(sizes, "stretch")


def merge_sorted_tables(
    spark: SparkSession, tables: list[DataFrame], key, tiebreak: bool = True, num_ranges: int | None = None,
    java_string_order: bool = False,
) -> DataFrame:
    """Merge written tables whose files are sorted by ``key`` into one order; rows with their rank ``pos``.

    The tables are read from files (``_metadata`` must be there); positions of
    sorted outputs are left out.  Duplicates are kept; no tables give no rows.
    Files that are not sorted inside give wrong ranks: check them first
    (:func:`sortproof.operators.verify.chunk_check`).
    """
    if not tables:
        return empty_records(spark).withColumn("pos", F.lit(None).cast("bigint"))
    cols = [c for c in tables[0].columns if c not in (RANGE_COL, OFFSET_COL, "pos")]
    rows = reduce(lambda a, b: a.unionByName(b), [
        t.select(*cols, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")) for t in tables
    ])
    keyed, plain = with_order_columns(rows, key)
    own = [c for c in keyed.columns if c not in ("_file", "_row")]
    text = sort_key(keyed, order_spec(plain, columns=own, tiebreak=tiebreak), java_string_order)
    files = write_and_read(file_stretches(keyed, text), scratch_path(spark, "merge-files"))
    n_files, n_alone = files.agg(F.count("*"), F.count_if("alone")).first()
    hint = F.broadcast if n_files <= BROADCAST_FILES else (lambda df: df)

    def of(which: DataFrame, *more: str) -> DataFrame:
        return rows.join(hint(which.select("_file", *more)), "_file")

    out = of(files.where("alone"), "before").select(*cols, (F.col("before") + F.col("_row") + 1).cast("bigint").alias("pos"))
    if n_alone < n_files:
        mixed = files.where("NOT alone")
        again = of(mixed, "stretch").select(*cols, "stretch")
        ranked = rank_records(
            again, [("stretch", True), *key_items(key)], num_ranges=num_ranges, tiebreak=tiebreak, java_string_order=java_string_order
        )
        shift = mixed.select("stretch", "alone_before").distinct()
        moved = ranked.join(hint(shift), "stretch").select(*cols, (F.col("pos") + F.col("alone_before")).cast("bigint").alias("pos"))
        out = moved if not n_alone else out.unionByName(moved)
    return out
