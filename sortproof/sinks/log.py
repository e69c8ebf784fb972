"""Ordered and keyed sinks (K1-K5).

Log tables use ``LOG_SCHEMA``.  Kafka variants are thin wrappers (the
connector jar is absent here, so they are untested); every Kafka sink is
at-least-once, so run the count and integrity checks after writing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sortproof._pickling import ship_by_value
from sortproof.functions.record import message_key, to_csv_checked
from sortproof.operators.merge import BROADCAST_FILES
from sortproof.operators.sort import (
    global_rank,
    range_sort,
    sorted_chunks,
    total_sort,
    with_positions,
    write_sorted,
)
from sortproof.schema import OFFSET_COL, RANGE_COL, RUN_COL
from sortproof.session import scratch_path, write_and_read
from sortproof.sinks.ledger import Folder, Ledger
from sortproof.sources.log import read_log

# Producer settings of the reference, as Spark Kafka writer options.
KAFKA_PRODUCER_OPTIONS = {
    "kafka.acks": "1",
    "kafka.linger.ms": "15",
    "kafka.batch.size": "131072",
    "kafka.compression.type": "zstd",
    "kafka.buffer.memory": "33554432",
}


def kafka_write_options(topic: str, bootstrap_servers: str, options: dict | None) -> dict:
    """Options of Spark's Kafka sink: the reference's producer settings, caller options win."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic, **KAFKA_PRODUCER_OPTIONS}
    opts.update(options or {})
    return opts


def _kafka_write(df: DataFrame, topic: str, bootstrap_servers: str, options: dict | None) -> None:
    df.write.format("kafka").options(**kafka_write_options(topic, bootstrap_servers, options)).save()


def write_keyed_log(
    records: DataFrame,
    topic: str,
    path: str | None = None,
    num_partitions: int = 4,
    bootstrap_servers: str | None = None,
    options: dict | None = None,
) -> DataFrame | None:
    """Keyed topic sink: key = decimal id, value = CSV line (K1).

    Table form: ``partition = pmod(xxhash64(key), num_partitions)``; the
    offset increases within every writing task (gaps allowed, as in a
    compacted topic); what was at ``path`` is replaced.  For dense offsets
    and further writes see :func:`append_keyed_log`.  Kafka form: the
    producer's partitioner decides, and every write appends.
    """
    kv = records.select(message_key().alias("key"), to_csv_checked().alias("value"))
    if bootstrap_servers:
        _kafka_write(kv, topic, bootstrap_servers, options)
        return None
    out = kv.select(
        "key",
        "value",
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64("key"), F.lit(num_partitions)).cast("int").alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
    return write_and_read(out, path)


def append_keyed_log(records: DataFrame, topic: str, path: str, num_partitions: int = 4) -> DataFrame:
    """Append to a keyed log table with dense offsets that go on per partition (K1); the new rows.

    Like :func:`write_keyed_log` a row's partition is a hash of its key.  Rows
    are landed once, each task's rows of a partition in a file of their own;
    a row's offset is then the partition's next offset (from the log's
    :class:`sortproof.sinks.ledger.Ledger`), plus the rows of the partition in
    earlier files (a prefix sum over one row per file), plus the row's place
    in its file.  No row is shuffled for it.  The append is staged and counts
    as a whole or not at all; two at once end in ``ConcurrentAppend``.
    """
    spark = records.sparkSession
    ledger = Ledger(spark, path)
    ledger.recover()
    start = ledger.next_offsets(topic)
    kv = records.select(message_key().alias("key"), to_csv_checked().alias("value"))
    placed = kv.withColumn("partition", F.pmod(F.xxhash64("key"), F.lit(num_partitions)).cast("int"))
    landed = write_and_read(placed, scratch_path(spark, "append"), partition_by=["partition"]).select(
        "key", "value", "partition", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    files = landed.groupBy("partition", "_file").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("partition").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = write_and_read(  # a row per file
        files.select("partition", "_file", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before")),
        scratch_path(spark, "append-files"),
    )
    sizes = {r["partition"]: r["n"] for r in files.groupBy("partition").agg(F.sum("n").alias("n")).collect()}
    first = spark.createDataFrame([(p, start.get(p, 0)) for p in range(num_partitions)], "partition int, _first long")
    offset = F.col("_first") + F.col("_before") + F.col("_row")
    small = F.broadcast if files.count() <= BROADCAST_FILES else (lambda df: df)
    version = ledger.claim()
    staging = f"_staging/{version:08d}"
    out = landed.join(small(files.drop("n")), ["partition", "_file"]).join(F.broadcast(first), "partition").select(
        "key", "value", F.lit(topic).alias("topic"), "partition", offset.alias("offset"), F.current_timestamp().alias("timestamp")
    )
    written = write_and_read(out, f"{path.rstrip('/')}/{staging}")
    found = written.groupBy(F.col("_metadata.file_name").alias("file"), "topic", "partition").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.count(F.lit(1)).alias("rows")
    )
    write_and_read(found, f"{path.rstrip('/')}/_ledger/files/version={version}")
    ledger.commit(version, topic, staging, {**start, **{p: start.get(p, 0) + n for p, n in sizes.items()}}, start)
    return read_log(spark, path, topic, from_offsets={p: start.get(p, 0) for p in range(num_partitions)})


def write_sorted_log(
    records: DataFrame, key, topic: str, path: str, num_ranges: int | None = None,
    java_string_order: bool = False,
) -> DataFrame:
    """Range-partitioned ordered log (K3): partition = range, offset = place in it.

    Partition ``i`` holds keys <= those of ``i+1``; concatenating partitions
    in order is the total order.  Null message keys, as in the reference.
    """
    s = (range_sort(records, key, num_ranges, java_string_order=java_string_order) if num_ranges
         else total_sort(records, key, java_string_order=java_string_order))
    out = with_positions(s).select(  # a projection on top of the sort: one write
        F.lit(None).cast("string").alias("key"),
        to_csv_checked().alias("value"),
        F.lit(topic).alias("topic"),
        F.col(RANGE_COL).cast("int").alias("partition"),
        F.col(OFFSET_COL).alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
    return write_and_read(out, path)


def range_files(table: DataFrame) -> dict[int, list[str]]:
    """``{range_id: [file paths]}`` of a written sorted table.

    One column-pruned scan; the result has one entry per written file, so
    collecting it is bounded by the file count, not the row count.
    """
    files: dict[int, list[str]] = {}
    for r in table.select(RANGE_COL, F.col("_metadata.file_path").alias("f")).distinct().collect():
        files.setdefault(r[RANGE_COL], []).append(r["f"])
    return files


def write_single_partition_log(
    records: DataFrame,
    key,
    topic: str,
    path: str | None = None,
    bootstrap_servers: str | None = None,
    options: dict | None = None,
    java_string_order: bool = False,
) -> DataFrame | None:
    """Totally ordered one-partition log: offset = rank - 1 (K2).

    Table form: the rank is computed in parallel (O8), so no task holds the
    whole output.  Kafka form: a one-partition topic is a serial log by
    nature; the ranges are produced one after another in key order, each
    by one task that reads only that range's files (:func:`range_files`).
    """
    spark = records.sparkSession
    table = write_sorted(records, key, scratch_path(spark, "sorted"), java_string_order=java_string_order)
    if bootstrap_servers:
        files = range_files(table)
        for rid in sorted(files):  # key order; each job reads only its range's files
            part = (spark.read.parquet(*files[rid]).filter(F.col(RANGE_COL) == rid)
                    .repartition(1).sortWithinPartitions(OFFSET_COL))
            _kafka_write(part.select(F.lit(None).cast("string").alias("key"), to_csv_checked().alias("value")),
                         topic, bootstrap_servers, options)
        return None
    ranked = global_rank(table)
    out = ranked.select(
        F.lit(None).cast("string").alias("key"),
        to_csv_checked().alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        (F.col("pos") - 1).alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
    return write_and_read(out, path)


def write_runs(
    records: DataFrame, key, path: str, budget_bytes: int, fmt: str = "parquet", chunk_rows: int | None = None,
    java_string_order: bool = False,
) -> None:
    """Sorted chunks within a byte budget, one part file per chunk (K4).

    ``fmt="text"`` writes CSV lines (the reference's run files);
    ``"parquet"`` keeps ``_metadata.row_index`` usable for the chunk check.
    A task writes the chunks of its input partition one after the other; the
    n-th chunks of all partitions share the folder ``run=n``.  Tasks move
    their files to the final folder themselves (committer version 2): the
    driver would else move every chunk's file, one after the other.  A
    repeated task replaces files of the same names.
    """
    chunks = sorted_chunks(records, key, budget_bytes, chunk_rows=chunk_rows, java_string_order=java_string_order)
    if fmt == "text":
        chunks = chunks.select(to_csv_checked().alias("value"), RUN_COL)
    w = chunks.write.mode("overwrite").partitionBy(RUN_COL).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    if fmt == "text":
        w.text(path)
    else:
        w.option("compression", "zstd").parquet(path)


def read_runs(spark, path: str) -> DataFrame:
    """Run files with their chunk (folder and file) and place in it (Parquet runs)."""
    return _with_chunks(spark.read.parquet(path))


def _with_chunks(runs: DataFrame) -> DataFrame:
    chunk = F.concat(F.col(RUN_COL).cast("string"), F.lit("/"), F.col("_metadata.file_name"))
    own = [c for c in runs.columns if c != RUN_COL]
    return runs.select(*own, chunk.alias("chunk"), F.col("_metadata.row_index").alias("row_index"))


def chunk_partition(chunk: Column | str) -> Column:
    """The input partition that a chunk of :func:`read_runs` was cut from, as Spark's writer numbers its files."""
    return F.regexp_extract(F.col(chunk) if isinstance(chunk, str) else chunk, r"/part-(\d+)", 1).cast("int")


#: Run files that the driver lists at once: it holds some kilobytes for each file of a table.
RUN_FILES_AT_ONCE = 50_000


def read_run_groups(spark, path: str, files_at_once: int = RUN_FILES_AT_ONCE) -> Iterator[DataFrame]:
    """:func:`read_runs` in groups of folders, about ``files_at_once`` files each: every file is in one group.

    For runs of so many files that the driver can't hold their list.  Each
    input partition has its first chunk in ``run=0``, so no folder has more
    files than that one.
    """
    top = Folder(spark, path)
    step = max(1, files_at_once // max(1, top.count(f"{RUN_COL}=0")))
    if top.count() <= step:
        yield read_runs(spark, path)
        return
    folders = [n for n in top.names() if n.startswith(f"{RUN_COL}=")]
    reader = spark.read.option("basePath", path)
    for i in range(0, len(folders), step):
        yield _with_chunks(reader.parquet(*[f"{top.path}/{n}" for n in folders[i : i + step]]))


def for_each_sorted_partition(sorted_df: DataFrame, fn: Callable[[Iterable], None]) -> None:
    """Push sorted rows to a callback, range by range (K5).

    ``fn`` gets the rows of one range in order; ranges run in parallel, so
    delivery is ordered only inside a range.
    """
    sorted_df.foreachPartition(fn)


def for_each_range(table: DataFrame, fn: Callable[[str, Iterable], None], epoch: str = "batch") -> None:
    """Push a written sorted table to a callback, range by range, each with its token (K5).

    ``fn(token, rows)`` gets every row of one range in order.  Ranges and
    places were fixed when the table was written, so a retried task pushes the
    same rows under the same token, and a callback that remembers tokens it
    has finished (:class:`sortproof.sinks.once.OnceFiles`) delivers each range
    once.  The rows are shuffled by their range; nothing is sampled or ranked
    again.
    """
    ranges = (table.agg(F.max(RANGE_COL)).first()[0] or 0) + 1
    rows = table.repartitionById(ranges, F.col(RANGE_COL)).sortWithinPartitions(OFFSET_COL)

    def push(part: Iterable) -> None:
        fn(f"{epoch}-{TaskContext.get().partitionId():06d}", part)

    rows.foreachPartition(push)


def stream_to_callback(stream_df: DataFrame, key, fn: Callable, checkpoint: str,
                       available_now: bool = True, ranges: str | None = None):
    """Streaming form of K5: every micro-batch is sorted and pushed to ``fn``.

    Each micro-batch is range-sorted and handed to ``fn(rows)`` range by range
    (ordered inside a range, ranges in parallel).  Order across micro-batches
    is arrival order, as in the reference's consumer loop.  Returns the
    started query (already finished when ``available_now``).

    With ``ranges``, a folder, a micro-batch is written there before it is
    pushed and ``fn(token, rows)`` gets tokens ``epoch-range``: a micro-batch
    that is run again, after a failure or a restart, finds its ranges as they
    were, so equal tokens always mean equal rows.  A micro-batch's ranges are
    dropped when a later one has been pushed.
    """
    spark = stream_df.sparkSession

    def _batch(batch: DataFrame, epoch: int) -> None:
        if ranges is None:
            total_sort(batch, key).foreachPartition(fn)
            return
        kept, name = Folder(spark, ranges), f"epoch={epoch:012d}"
        if not kept.exists(f"{name}/_SUCCESS"):
            write_sorted(batch, key, f"{ranges.rstrip('/')}/{name}")
        for_each_range(spark.read.parquet(f"{ranges.rstrip('/')}/{name}"), fn, f"{epoch:012d}")
        for old in kept.names():
            if old < name:
                kept.delete(old)

    w = stream_df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(_batch)
    q = (w.trigger(availableNow=True) if available_now else w).start()
    if available_now:
        q.awaitTermination()
    return q


ship_by_value(__name__)
