"""Bounded and incremental reads of a message log, and text-line files.

A *log table* is a Parquet table with the columns of Spark's Kafka source
(``LOG_SCHEMA``).  Every function also accepts Kafka connection settings;
the Kafka connector jar is not part of this environment, so those paths are
thin and untested here.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sortproof.schema import LOG_SCHEMA
from sortproof.sinks.ledger import Ledger

_LOG_COLS = [f.name for f in LOG_SCHEMA.fields]

# Default rate limits: every micro-batch (and so every stateful group in it)
# stays bounded however large the backlog is; `availableNow` still drains all.
DEFAULT_MAX_FILES_PER_TRIGGER = 256
DEFAULT_MAX_OFFSETS_PER_TRIGGER = 50_000_000


def _kafka_options(bootstrap_servers: str, topic: str, options: dict | None) -> dict:
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        # the reference's consumer fetch sizes
        "kafka.fetch.min.bytes": "65536",
        "kafka.max.partition.fetch.bytes": "1048576",
    }
    opts.update(options or {})
    return opts


def kafka_read_options(spark: SparkSession, bootstrap_servers: str, topic: str, options: dict | None,
                       stream: bool) -> dict:
    """Options of Spark's Kafka source for a whole-topic read (batch or stream).

    Reads from the earliest offset; a batch read ends at the offsets current
    at planning time (the end of a drain), a stream is rate-limited.  Topics
    with few partitions (4 in the reference) are split into offset ranges so
    that every core reads (``minPartitions``).  Caller options win.
    """
    opts = _kafka_options(bootstrap_servers, topic, options)
    opts.setdefault("startingOffsets", "earliest")
    if stream:
        opts.setdefault("maxOffsetsPerTrigger", str(DEFAULT_MAX_OFFSETS_PER_TRIGGER))
    else:
        opts.setdefault("endingOffsets", "latest")
    opts.setdefault("minPartitions", str(spark.sparkContext.defaultParallelism))
    return opts


def _kafka_projection(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def read_log(
    spark: SparkSession,
    path: str | None = None,
    topic: str | None = None,
    bootstrap_servers: str | None = None,
    options: dict | None = None,
    from_offsets: dict[int, int] | None = None,
    to_offsets: dict[int, int] | None = None,
) -> DataFrame:
    """Bounded scan of a topic: earliest to the current end, or a stretch of it.

    With ``bootstrap_servers`` this is Spark's Kafka batch source (a fixed
    offset range, so every job sees everything, no consumer group needed);
    otherwise a Parquet log table at ``path``, optionally one ``topic``.

    ``from_offsets`` and ``to_offsets`` give the first offset of a partition
    and the one after its last; partitions not named are read from their start
    or to their end.  A log that has been appended to knows its files' offsets
    (:mod:`sortproof.sinks.ledger`) and only files that can hold such rows are
    read; in any log the bounds go to the Parquet scan as a filter.
    """
    stretch = from_offsets is not None or to_offsets is not None
    if bootstrap_servers:
        opts = dict(options or {})
        for name, offsets, default in (("startingOffsets", from_offsets, -2), ("endingOffsets", to_offsets, -1)):
            if offsets is not None:  # Kafka wants every partition; those of the other map take earliest or latest
                parts = {*(from_offsets or {}), *(to_offsets or {})}
                opts[name] = json.dumps({topic: {str(p): offsets.get(p, default) for p in sorted(parts)}})
        opts = kafka_read_options(spark, bootstrap_servers, topic, opts, stream=False)
        return _kafka_projection(spark.read.format("kafka").options(**opts).load())
    paths = [path]
    if stretch:
        files = files_of_stretch(spark, path, topic, from_offsets or {}, to_offsets or {})
        if files is not None:
            if not files:
                return spark.createDataFrame([], LOG_SCHEMA)
            paths = files
    df = spark.read.schema(LOG_SCHEMA).parquet(*paths)
    df = df.filter(F.col("topic") == topic) if topic else df
    return df.filter(in_stretch(from_offsets or {}, to_offsets or {})) if stretch else df


def in_stretch(from_offsets: dict[int, int], to_offsets: dict[int, int]) -> Column:
    """Rows of a log between two maps of offsets; comparisons that a Parquet scan can use."""
    named = sorted({*from_offsets, *to_offsets})
    cond = ~F.col("partition").isin(named)
    for p in named:
        own = F.col("partition") == p
        if p in from_offsets:
            own = own & (F.col("offset") >= from_offsets[p])
        if p in to_offsets:
            own = own & (F.col("offset") < to_offsets[p])
        cond = cond | own
    return cond


#: Above so many files, a stretch is read by its filter alone.
MOST_FILES = 10_000


def files_of_stretch(
    spark: SparkSession, path: str, topic: str | None, from_offsets: dict[int, int], to_offsets: dict[int, int]
) -> list[str] | None:
    """Files of an appended log that can hold rows of the stretch; None where that isn't known."""
    ledger = Ledger(spark, path)
    files = ledger.files()
    if files is None or files.isEmpty():
        return None
    cond = ~F.col("partition").isin(sorted({*from_offsets, *to_offsets}))
    for p in {*from_offsets, *to_offsets}:
        own = F.col("partition") == p
        if p in from_offsets:
            own = own & (F.col("last") >= from_offsets[p])
        if p in to_offsets:
            own = own & (F.col("first") < to_offsets[p])
        cond = cond | own
    found = files.filter(cond if topic is None else cond & (F.col("topic") == topic))
    names = [r["file"] for r in found.select("file").distinct().limit(MOST_FILES + 1).collect()]
    return None if len(names) > MOST_FILES else [f"{path.rstrip('/')}/{n}" for n in sorted(names)]


def stream_log(
    spark: SparkSession,
    path: str | None = None,
    topic: str | None = None,
    bootstrap_servers: str | None = None,
    options: dict | None = None,
    max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
) -> DataFrame:
    """Incremental scan of a topic as a streaming DataFrame (S3).

    Micro-batches are rate-limited by default (files per trigger for a log
    table, offsets per trigger for Kafka), so a backlog is processed in
    bounded steps.
    """
    if bootstrap_servers:
        opts = kafka_read_options(spark, bootstrap_servers, topic, options, stream=True)
        return _kafka_projection(spark.readStream.format("kafka").options(**opts).load())
    reader = spark.readStream.schema(LOG_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.parquet(path)
    return df.filter(F.col("topic") == topic) if topic else df


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Newline-separated text files as a ``value`` column; empty lines skipped."""
    return spark.read.text(paths).select("value").filter(F.col("value") != "")
