"""Sorts, ranks, chunks and merges.

Total order at scale is Spark's range shuffle: ``orderBy`` samples the
keys, cuts the key space into ranges, shuffles each row to its range and
sorts every range locally (external sort with spill).  Concatenating the
ranges in order gives the total order - no task ever holds more than one
range.

Positions are made explicit in the same stage that sorts: ``range_id`` is
the partition index after the range shuffle and ``offset`` the row's place
inside it.  The sorted table is written once to the shared checkpoint
folder; the global rank is then ``(rows in earlier ranges) + offset + 1``,
where the per-range counts form a table with one row per range (bounded by
the partition count, so it is safe to broadcast).  Range bounds are chosen
by sampling and differ between executions, so positions are only ever read
back from the written table, never recomputed.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sortproof.functions.cutting import chunk_numbers
from sortproof.functions.record import size_estimate
from sortproof.operators.ordering import By, key_items, with_order_columns
from sortproof.schema import OFFSET_COL, RANGE_COL, RECORD_COLUMNS, RECORD_SCHEMA, RUN_COL, SORT_KEYS
from sortproof.session import scratch_path, write_and_read

SortSpec = list[tuple[str, bool]]

# Reference default for the run budget (150 MiB of estimated row bytes).
DEFAULT_RUN_BUDGET = 157_286_400
_PARTITION_SHIFT = 33  # monotonically_increasing_id starts partition p at p * 2^33
_BLOCK_SHIFT = 12  # rows of a block that copies are told apart by, as a power of 2
_DUP = "_copy"  # input partition id appended to every tie-broken sort key


# --------------------------------------------------------------- key specs
def order_spec(key, columns: list[str] | None = None, tiebreak: bool = True) -> SortSpec:
    """Normalise a sort key into ``[(column, ascending), ...]``.

    ``key`` is a named key (``"id"``, ``"Name"``, ``"CONTINENT"``), a column
    name, ``"-col"`` for descending, a ``(column, ascending)`` tuple, or a
    list of these.  With ``tiebreak`` the remaining columns follow in
    ascending order, which makes the order (and every rank) reproducible.
    Expressions (:class:`sortproof.operators.ordering.By`) are made columns
    before, by the functions that sort, rank and check.
    """
    columns = list(columns or RECORD_COLUMNS)
    items = key_items(key)
    if not items:
        raise ValueError("no sort column given")
    spec: SortSpec = []
    for it in items:
        if isinstance(it, tuple):
            name, asc = it
        else:
            if it is None or not str(it).strip():
                raise ValueError("a sort column has no name")
            s = str(it).strip()
            asc = not s.startswith("-")
            s = s.lstrip("+-")
            name = SORT_KEYS.get(s.upper(), s)
        if name not in columns:
            raise ValueError(f"cannot sort by {it!r}: the columns are {', '.join(columns)}")
        spec.append((name, bool(asc)))
    if tiebreak:
        used = {n for n, _ in spec}
        spec += [(c, True) for c in columns if c not in used]
    return spec


def key_column(df: DataFrame, name: str, java_string_order: bool = False) -> Column:
    """The comparable form of a key column.

    Spark orders strings by UTF-8 bytes (code points); Java's
    ``String.compareTo`` by UTF-16 units.  They differ only when characters
    above U+FFFF meet U+E000..U+FFFF; ``java_string_order`` compares the
    UTF-16BE bytes instead, which is exactly Java's order.
    """
    c = F.col(name)
    if java_string_order and dict(df.dtypes).get(name) == "string":
        return F.encode(c, "UTF-16BE")
    return c


def sort_exprs(df: DataFrame, spec: SortSpec, java_string_order: bool = False) -> list[Column]:
    out = []
    for name, asc in spec:
        c = key_column(df, name, java_string_order)
        out.append(c.asc() if asc else c.desc())
    return out


def _spec(df: DataFrame, key, tiebreak: bool) -> SortSpec:
    return order_spec(key, columns=[c for c in df.columns if c not in (RANGE_COL, OFFSET_COL, _DUP)],
                      tiebreak=tiebreak)


# --------------------------------------------------------------- O1-O4, O7
def _with_copy_breaker(df: DataFrame, tiebreak: bool, stable_input: bool = False) -> tuple[DataFrame, list[Column]]:
    """Spread identical rows over ranges.

    With every column in the key, identical copies still share one key, and
    the range partitioner sends equal keys to one range: a record repeated
    for a third of the input would make one task sort a third of the data.
    The input partition id as the very last key splits such a record into
    one key per input partition, so ranges balance at the granularity of an
    input partition.  It is order-independent: a retried map task (whose row
    order may differ after a shuffle) routes every row exactly as before,
    which a row counter would not guarantee.  Copies are interchangeable, so
    any order among them is a correct result.

    ``stable_input`` says that ``df`` is a scan of written files (a landed
    table), whose rows come in the same order in every attempt.  Then the
    breaker also counts blocks of rows inside a partition, and copies spread
    however few the partitions are.
    """
    if not tiebreak:
        return df, []
    place = F.shiftright(F.monotonically_increasing_id(), _BLOCK_SHIFT) if stable_input else F.spark_partition_id()
    return df.withColumn(_DUP, place), [F.col(_DUP).asc()]


def total_sort(
    df: DataFrame, key, tiebreak: bool = True, java_string_order: bool = False, stable_input: bool = False
) -> DataFrame:
    """Total order by ``key`` (O1 id, O2 name, O3 continent, O4 any order).

    Without ``tiebreak`` all rows of one key fall into one range, so a key
    that holds much of the input makes one task sort it all.
    """
    keyed, plain = with_order_columns(df, key)
    exprs = sort_exprs(keyed, _spec(keyed, plain, tiebreak), java_string_order)
    tagged, extra = _with_copy_breaker(keyed, tiebreak, stable_input)
    return _without(tagged.orderBy(*exprs, *extra), df)


def range_sort(
    df: DataFrame, key, num_ranges: int, tiebreak: bool = True, java_string_order: bool = False,
    stable_input: bool = False,
) -> DataFrame:
    """Range-partitioned sort with an explicit number of ranges.

    Partition ``i`` holds only keys <= those of partition ``i+1`` and is
    sorted; the concatenation of partitions is the total order.  The bounds
    are sampled anew in every run; :mod:`sortproof.operators.splitters` keeps
    them.
    """
    keyed, plain = with_order_columns(df, key)
    exprs = sort_exprs(keyed, _spec(keyed, plain, tiebreak), java_string_order)
    tagged, extra = _with_copy_breaker(keyed, tiebreak, stable_input)
    return _without(tagged.repartitionByRange(num_ranges, *exprs, *extra).sortWithinPartitions(*exprs, *extra), df)


def _without(sorted_df: DataFrame, df: DataFrame) -> DataFrame:
    """The sorted rows without the columns made for the sort."""
    return sorted_df.drop(*[c for c in sorted_df.columns if c not in df.columns])


def with_positions(sorted_df: DataFrame) -> DataFrame:
    """Tag each row of a just-sorted DataFrame with ``range_id`` and ``offset``.

    Must sit directly on top of the sort: both values come from the
    partition the row is in and its place there.  The partition's start is
    subtracted, so offsets stay right beyond 2^33 rows in one range.
    """
    start = F.shiftleft(F.spark_partition_id().cast("bigint"), _PARTITION_SHIFT)
    return sorted_df.withColumn(RANGE_COL, F.spark_partition_id()).withColumn(
        OFFSET_COL, F.monotonically_increasing_id() - start
    )


def write_sorted(
    df: DataFrame,
    key,
    path: str,
    num_ranges: int | None = None,
    tiebreak: bool = True,
    java_string_order: bool = False,
    mode: str = "overwrite",
    stable_input: bool = False,
) -> DataFrame:
    """Sort and write a range-partitioned ordered table (K3); return it read back.

    One part file per range, each sorted; ``range_id``/``offset`` columns
    hold the position, because reading files back does not keep row order.
    """
    if num_ranges:
        s = range_sort(df, key, num_ranges, tiebreak, java_string_order, stable_input)
    else:
        s = total_sort(df, key, tiebreak, java_string_order, stable_input)
    return write_and_read(with_positions(s), path, mode)


def write_sorted_observed(
    df: DataFrame, key, path: str, num_ranges: int | None = None, impl: str = "jvm",
    java_string_order: bool = False, stable_input: bool = False,
) -> tuple[DataFrame, dict]:
    """:func:`write_sorted` that also returns ``{"rows", "checksum"}`` of what it wrote.

    The metrics are attached above the sort, so they are computed once, in
    the write stage; below the range shuffle they would also run in the
    sampling job that picks the range bounds.
    """
    from sortproof.operators.aggregate import observe_records, observed_metrics

    own = {"java_string_order": java_string_order, "stable_input": stable_input}
    s = range_sort(df, key, num_ranges, **own) if num_ranges else total_sort(df, key, **own)
    observed, obs = observe_records(with_positions(s), "sorted_write", impl=impl)
    table = write_and_read(observed, path)
    return table, observed_metrics(obs)


def global_rank(table: DataFrame, rank_col: str = "pos") -> DataFrame:
    """1-based rank of every row of a positioned table.

    ``(rows in earlier ranges) + offset + 1``.  The per-range counts are one
    row per range; only that table passes a single-partition window and the
    broadcast.
    """
    counts = table.groupBy(RANGE_COL).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(RANGE_COL).rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(RANGE_COL, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return (
        table.join(F.broadcast(base), RANGE_COL)
        .withColumn(rank_col, (F.col("_base") + F.col(OFFSET_COL) + 1).cast("bigint"))
        .drop("_base")
    )


def rank_records(
    df: DataFrame,
    key,
    num_ranges: int | None = None,
    tiebreak: bool = True,
    java_string_order: bool = False,
    keep_positions: bool = False,
    path: str | None = None,
) -> DataFrame:
    """Sort ``df`` and return every row with its 1-based global rank ``pos``."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "sorted")
    table = write_sorted(df, key, path, num_ranges, tiebreak, java_string_order)
    ranked = global_rank(table)
    return ranked if keep_positions else ranked.drop(RANGE_COL, OFFSET_COL)


# --------------------------------------------------------------- O5
def sorted_chunks(
    df: DataFrame, key, budget_bytes: int = DEFAULT_RUN_BUDGET, tiebreak: bool = True,
    chunk_rows: int | None = None, java_string_order: bool = False, size: Column | None = None,
) -> DataFrame:
    """Cut the input into chunks of ``budget_bytes`` estimated bytes and sort each.

    Every input partition is cut in order of arrival, as a task that fills a
    buffer and spills it would do: the row that brings a chunk to the budget
    is its last one, so no chunk exceeds the budget by more than one row, and
    only a partition's last chunk is smaller.  Nothing is shuffled.  Column
    ``run`` numbers the chunks of a partition; rows come chunk after chunk,
    sorted inside.  ``size`` is a row's bytes (default: the estimate of a
    record, A5); ``chunk_rows`` cuts by a number of rows instead.
    """
    if chunk_rows is None and budget_bytes <= 0:
        raise ValueError("budget_bytes must be positive")
    keyed, plain = with_order_columns(df, key)
    exprs = sort_exprs(keyed, _spec(keyed, plain, tiebreak), java_string_order)
    if chunk_rows is None:
        run = chunk_numbers(size_estimate() if size is None else size, budget_bytes)
    else:
        start = F.shiftleft(F.spark_partition_id().cast("bigint"), _PARTITION_SHIFT)
        run = F.floor((F.monotonically_increasing_id() - start) / F.lit(chunk_rows))
    return keyed.withColumn(RUN_COL, run).sortWithinPartitions(RUN_COL, *exprs).select(*df.columns, RUN_COL)


# --------------------------------------------------------------- O6
def empty_records(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RECORD_SCHEMA)


def merge_sorted(spark: SparkSession, inputs: list[DataFrame], key, tiebreak: bool = True,
                 num_ranges: int | None = None, java_string_order: bool = False) -> DataFrame:
    """Merge sorted inputs into one total order, duplicates kept.

    UNION ALL then one range sort; an empty list gives an empty result.
    Returns the rows with their global rank ``pos``.
    """
    if not inputs:
        return empty_records(spark).withColumn("pos", F.lit(None).cast("bigint"))
    cols = [c for c in inputs[0].columns if c not in (RANGE_COL, OFFSET_COL, "pos")]
    union = reduce(lambda a, b: a.unionByName(b), [d.select(*cols) for d in inputs])
    return rank_records(union, key, num_ranges=num_ranges, tiebreak=tiebreak, java_string_order=java_string_order)


# --------------------------------------------------------------- O9
def order_name(key, columns: list[str] | None = None) -> str:
    """A name for an order that no other order has: ``id``, ``id_desc``, ``name__id_desc``."""
    parts = [
        (i.name, i.ascending) if isinstance(i, By) else order_spec(i, columns=columns, tiebreak=False)[0] for i in key_items(key)
    ]
    return "__".join(name if asc else f"{name}_desc" for name, asc in parts)


def order_names(keys, columns: list[str] | None = None) -> list[str]:
    """Names of several orders; raises if two of them are the same order."""
    names = [order_name(k, columns) for k in keys]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"the same order is asked for twice: {', '.join(twice)}")
    return names


def sort_many(
    df: DataFrame, keys, out_root: str, num_ranges: int | None = None, land: bool = True,
    java_string_order: bool = False,
) -> dict[str, DataFrame]:
    """Several sorted outputs from one source (O9), by the names of their orders.

    The source is parsed/joined once and landed as Parquet, so each sort
    reads the landed columns instead of recomputing the input.
    """
    spark = df.sparkSession
    names = order_names(keys, df.columns)
    src = write_and_read(df, f"{out_root.rstrip('/')}/_landed") if land else df
    # Independent jobs over the same landed input: run them concurrently so
    # one sort's stragglers do not leave the cluster idle.
    with ThreadPoolExecutor(max_workers=max(1, len(names))) as pool:
        futures = {
            name: pool.submit(
                inheritable_thread_target(spark)(write_sorted), src, k, f"{out_root.rstrip('/')}/{name}", num_ranges,
                java_string_order=java_string_order, stable_input=land,
            )
            for name, k in zip(names, keys, strict=True)
        }
        return {name: f.result() for name, f in futures.items()}
