"""Structured Streaming versions of landing, counting and order checks.

The reference drains a topic with poll loops and stops after a number of
empty polls.  Here the end is an offset snapshot: ``trigger(availableNow=
True)`` processes everything present at start (in as many micro-batches as
the rate limits ask for) and stops; the checkpoint replaces consumer
offsets, so a rerun continues where the last one ended.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sortproof.functions.record import row_hash, wrap_int64
from sortproof.operators.parse import parse_quarantine, parse_strict, tag_lines
from sortproof.operators.sort import key_column, write_sorted
from sortproof.sinks.ledger import Folder


# ------------------------------------------------------------------ T1
def drain(stream_df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> DataFrame:
    """Append everything available now to a table, then stop.

    Nothing there yet gives an empty table.
    """
    q = (
        stream_df.writeStream.format(fmt)
        .option("checkpointLocation", checkpoint)
        .option("compression", "zstd")
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )
    q.awaitTermination()
    return _read_or_empty(stream_df.sparkSession, path, stream_df.schema, fmt)


def _read_or_empty(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The table a stream wrote, or an empty one if no micro-batch ever ran; other errors are raised."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


# ------------------------------------------------------------------ T2
def stream_stats(log_stream: DataFrame, impl: str = "jvm") -> DataFrame:
    """Running ``(topic, n, checksum)`` over a log stream; constant state.

    Bad lines are not counted (``rejected`` counts them instead).
    """
    rec = tag_lines(log_stream, keep=("topic",)).withColumnRenamed("reason", "_r")
    good = F.col("_r").isNull()
    hashed = rec.select("topic", "_r", F.when(good, row_hash(impl=impl)).alias("_h"))
    agg = hashed.groupBy("topic").agg(
        F.count("_h").alias("n"),
        F.sum(F.col("_h").cast("decimal(38,0)")).alias("_s"),
        F.count("_r").alias("rejected"),
    )
    return agg.select("topic", "n", wrap_int64(F.coalesce("_s", F.lit(0).cast("decimal(38,0)"))).alias("checksum"),
                      "rejected")


def run_complete(stats_stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a complete-mode aggregate to the end; the table holds the final result."""

    def _write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").option("compression", "zstd").parquet(path)

    q = (
        stats_stream.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(_write)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return _read_or_empty(stats_stream.sparkSession, path, stats_stream.schema)


# ------------------------------------------------------------------ T3
#: Consecutive offsets of a log partition that one window partition holds.
MONITOR_CHUNK_ROWS = 1 << 20


def _batch_chunks(batch: DataFrame, key: str, ascending: bool, chunk_rows: int, java_string_order: bool) -> DataFrame:
    """One row per (topic, partition, chunk) of a micro-batch: counts, edges, violations inside.

    All on the JVM: one shuffle by chunk for the neighbour comparison, and
    the aggregation of a chunk in place.  Lines that don't parse are counted
    as rejected and have no key to compare.
    """
    tagged = tag_lines(batch, keep=("topic", "partition", "offset"))
    k = key_column(tagged, key, java_string_order)
    rows = tagged.select(
        "topic", "partition", "offset", F.expr(f"offset div {int(chunk_rows)}").alias("chunk"),
        F.col("reason").isNotNull().alias("rejected"), F.when(F.col("reason").isNull(), k).alias("k"),
    )
    good = Window.partitionBy("topic", "partition", "chunk").orderBy("rejected", "offset")  # good lines first
    rows = rows.withColumn("prev", F.lag("k").over(good))
    later, earlier = (F.col("k"), F.col("prev")) if ascending else (F.col("prev"), F.col("k"))
    rows = rows.withColumn("bad", F.coalesce(~F.col("rejected") & (earlier > later), F.lit(False)))
    place = F.when(~F.col("rejected"), F.col("offset"))
    return rows.groupBy("topic", "partition", "chunk").agg(
        F.count_if(~F.col("rejected")).alias("n"), F.count_if("rejected").alias("rejected"),
        F.count_if("bad").alias("bad"), F.min(F.when(F.col("bad"), F.col("offset"))).alias("first_bad"),
        F.min(place).alias("first_offset"), F.max(place).alias("last_offset"),
        F.min_by("k", place).alias("first_key"), F.max_by("k", place).alias("last_key"),
        F.min("offset").alias("low"), F.max("offset").alias("high"),
    )


#: Stretches of offsets kept per log partition: arrivals may be so far out of order.
MOST_STRETCHES = 16


def fold_stretches(state: DataFrame | None, chunks: DataFrame, ascending: bool, most: int = MOST_STRETCHES) -> DataFrame:
    """The state after a micro-batch: at most ``most`` + 1 rows per log partition.

    A row is a stretch of offsets that has been looked at: what
    :func:`_batch_chunks` says of a chunk, with ``regressions``, the chunks
    that came behind offsets already seen.  In order of offsets, stretches
    that touch become one; the edge between them is compared then.  If more
    than ``most`` are left, the lowest ones become one as if nothing could
    come between them any more.  So a log read in order has one row per
    partition, however long it is, and files read out of order are still
    compared with their neighbours.  Chunks without a good line only add to
    the partition's rejected lines.
    """
    parts = ["topic", "partition"]
    new = chunks.drop("chunk").withColumn("regressions", F.lit(0).cast("bigint"))
    rows = new
    if state is not None:
        seen = state.groupBy(*parts).agg(F.max("last_offset").alias("_seen"))  # a row per log partition
        late = F.coalesce(F.col("_seen") >= F.col("first_offset"), F.lit(False)).cast("bigint")
        rows = state.select(*new.columns).unionByName(
            chunks.join(seen, parts, "left").withColumn("regressions", late).select(*new.columns)
        )
    good = rows.withColumn("_empty", F.col("n") == 0)
    place = Window.partitionBy(*parts, "_empty").orderBy("first_offset", "last_offset")
    whole = Window.partitionBy(*parts, "_empty")
    joined = good.select(
        "*", F.lag("last_key").over(place).alias("_before"), F.lag("last_offset").over(place).alias("_upto"),
        F.lag("high").over(place).alias("_high"),
    )
    starts = (~F.coalesce(F.col("_high") + 1 == F.col("low"), F.lit(False))).cast("int")
    numbered = joined.withColumn("_number", F.sum(starts).over(place))
    above = F.col("_number") - (F.max("_number").over(whole) - F.lit(most))
    numbered = numbered.withColumn("_group", F.when(F.col("_empty"), F.lit(0)).otherwise(F.greatest(F.lit(1), above)))
    inside = F.col("_group") == F.lag("_group").over(place)  # a group's first row is compared later
    numbered = numbered.withColumn("_edge", F.coalesce(
        inside & (F.col("_upto") < F.col("first_offset")) & _wrong(F.col("_before"), F.col("first_key"), ascending), F.lit(False)))
    return numbered.groupBy(*parts, "_group").agg(
        F.sum("n").alias("n"), F.sum("rejected").alias("rejected"), (F.sum("bad") + F.count_if("_edge")).alias("bad"),
        F.min(F.least("first_bad", F.when(F.col("_edge"), F.col("first_offset")))).alias("first_bad"),
        F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"),
        F.min_by("first_key", "first_offset").alias("first_key"), F.max_by("last_key", "last_offset").alias("last_key"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("regressions").alias("regressions"),
    ).select(*new.columns)


def _wrong(earlier: Column, later: Column, ascending: bool) -> Column:
    return F.coalesce((earlier > later) if ascending else (earlier < later), F.lit(False))


class Snapshots:
    """Versions of a small state under ``path``, one per micro-batch, of which the last two are kept.

    The state of a micro-batch is computed from the version before it, so a
    micro-batch that runs again gives the same version again.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self.folder = spark, path.rstrip("/"), Folder(spark, path)

    def _versions(self) -> list[int]:
        return [int(n[1:]) for n in self.folder.names() if n[:1] == "v" and self.folder.exists(f"{n}/_SUCCESS")]

    def _name(self, epoch: int) -> str:
        return f"v{epoch:012d}"

    def latest(self, before: int | None = None) -> DataFrame | None:
        """The last whole version, or the last one before a micro-batch."""
        known = [v for v in self._versions() if before is None or v < before]
        return self.spark.read.parquet(f"{self.path}/{self._name(max(known))}") if known else None

    def put(self, epoch: int, state: DataFrame) -> None:
        state.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/{self._name(epoch)}")
        known = sorted(v for v in self._versions() if v <= epoch)
        for old in known[:-2]:
            self.folder.delete(self._name(old))


def run_order_monitor(
    log_stream: DataFrame, path: str, checkpoint: str, key: str = "id", ascending: bool = True,
    chunk_rows: int = MONITOR_CHUNK_ROWS, java_string_order: bool = False, most_stretches: int = MOST_STRETCHES,
) -> DataFrame:
    """Check a log stream's order on ``key`` as it arrives; the state so far per log partition.

    Each micro-batch is reduced to one row per (topic, partition, chunk of
    offsets) and folded into the state before it (:func:`fold_stretches`),
    whose size depends on the number of log partitions alone.  The state is a
    version per micro-batch under ``path``: a retried micro-batch replaces its
    own, and a later run goes on where the checkpoint does.  The result joins
    what is left apart: see :func:`order_state`.
    """
    spark = log_stream.sparkSession
    states = Snapshots(spark, path)

    def _write(batch: DataFrame, epoch: int) -> None:
        chunks = _batch_chunks(batch, key, ascending, chunk_rows, java_string_order)
        states.put(epoch, fold_stretches(states.latest(before=epoch), chunks, ascending, most_stretches).coalesce(1))

    q = (
        log_stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(_write).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    state = states.latest()
    if state is None:
        empty = spark.createDataFrame([], log_stream.schema)
        state = fold_stretches(None, _batch_chunks(empty, key, ascending, chunk_rows, java_string_order), ascending)
    return order_state(state, ascending)


def order_state(stretches: DataFrame, ascending: bool = True) -> DataFrame:
    """Per log partition: ``n, rejected, violations, first_violation, offset_regressions``.

    ``stretches`` is a state (:func:`fold_stretches`).  In order of offsets,
    the first key of a stretch is compared with the last key before it; the
    first key of a partition with the last key of the partitions before it (a
    sorted log is its partitions one after the other).  Where the offsets of
    two micro-batches interleave, their keys can't be compared any more; this
    and data that arrive behind offsets already seen are counted in
    ``offset_regressions``.  ``first_violation`` is the offset of the first
    violating row.
    """
    parts = ["topic", "partition"]
    place = Window.partitionBy(*parts).orderBy("first_offset", "last_offset")
    full = stretches.filter(F.col("n") > 0)
    edges = full.select("*", F.lag("last_key").over(place).alias("before"), F.lag("last_offset").over(place).alias("upto"))
    apart = F.coalesce(F.col("upto") < F.col("first_offset"), F.lit(False))
    edge = apart & _wrong(F.col("before"), F.col("first_key"), ascending)
    by_part = edges.groupBy(*parts).agg(
        F.sum("n").alias("n"), (F.sum("bad") + F.count_if(edge)).alias("inside"),
        F.min(F.least("first_bad", F.when(edge, F.col("first_offset")))).alias("first_inside"),
        F.sum("regressions").alias("offset_regressions"),
        F.min_by("first_key", "first_offset").alias("first_key"), F.max_by("last_key", "last_offset").alias("last_key"),
        F.min("first_offset").alias("first_offset"),
    )
    in_order = Window.partitionBy("topic").orderBy("partition")  # one row per log partition
    across = _wrong(F.lag("last_key").over(in_order), F.col("first_key"), ascending)
    out = by_part.withColumn("_across", across).select(
        *parts, "n", (F.col("inside") + F.col("_across").cast("bigint")).alias("violations"),
        F.when(F.col("_across"), F.col("first_offset")).otherwise(F.col("first_inside")).alias("first_violation"),
        "offset_regressions",
    )
    rejected = stretches.groupBy(*parts).agg(F.sum("rejected").alias("rejected"))
    zero = F.lit(0).cast("bigint")
    return rejected.join(out, parts, "left").select(
        *parts, F.coalesce("n", zero).alias("n"), "rejected", F.coalesce("violations", zero).alias("violations"),
        "first_violation", F.coalesce("offset_regressions", zero).alias("offset_regressions"),
    )


# ------------------------------------------------------------------ T4
def land_and_sort(
    log_stream: DataFrame, landing: str, checkpoint: str, key, out_path: str, num_ranges: int | None = None,
    mode: str = "failfast", java_string_order: bool = False,
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Land a stream (append), then sort the landed data in batch (T4).

    A streaming ``orderBy`` exists only after a complete-mode aggregation,
    so the total order is a batch job over the landed table.  ``failfast``
    fails the job on a line that doesn't parse, as the batch sort does;
    ``quarantine`` sorts the good lines and also returns the others with
    their reasons (written under ``out_path`` + ``_parsed``).
    """
    if mode not in ("failfast", "quarantine"):
        raise ValueError(f"mode must be failfast or quarantine, not {mode!r}")
    landed = drain(log_stream, landing, checkpoint)
    if mode == "failfast":
        return write_sorted(parse_strict(landed), key, out_path, num_ranges, java_string_order=java_string_order)
    good, rejects = parse_quarantine(landed, f"{out_path.rstrip('/')}_parsed")
    return write_sorted(good, key, out_path, num_ranges, java_string_order=java_string_order), rejects
