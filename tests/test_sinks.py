"""Ordered and keyed sinks, and the whole job end to end."""

import uuid

import pytest
from pyspark.sql import functions as F

from sortproof.operators.sort import total_sort
from sortproof.operators.verify import order_violations
from sortproof.plans.end_to_end import run_end_to_end
from sortproof.sinks.log import (
    for_each_sorted_partition,
    write_keyed_log,
    write_single_partition_log,
    write_sorted_log,
)

ROWS = [(i * 37 % 211 - 100, f"n{i % 17}", f"a{i}", ["Asia", "Europe"][i % 2]) for i in range(600)]


def _p(tmp_path, name):
    return str(tmp_path / f"{name}-{uuid.uuid4().hex[:6]}")


def test_keyed_log(spark, records_df, tmp_path):
    log = write_keyed_log(records_df(ROWS), "source", _p(tmp_path, "k"), num_partitions=4)
    rows = log.collect()
    assert len(rows) == 600 and {r.topic for r in rows} == {"source"}
    assert {r.partition for r in rows} <= {0, 1, 2, 3}
    assert all(r.key == r.value.split(",")[0] for r in rows)
    # same key -> same partition
    by_key = {}
    for r in rows:
        by_key.setdefault(r.key, set()).add(r.partition)
    assert all(len(p) == 1 for p in by_key.values())
    # offsets increase and are unique within a partition
    assert log.groupBy("partition").agg(F.countDistinct("offset").alias("d"), F.count("*").alias("n")) \
        .filter("d != n").count() == 0


def test_single_partition_log_offsets_are_ranks(spark, records_df, tmp_path):
    log = write_single_partition_log(records_df(ROWS), "id", "id", _p(tmp_path, "one"))
    rows = sorted(log.collect(), key=lambda r: r.offset)
    assert [r.offset for r in rows] == list(range(600)) and {r.partition for r in rows} == {0}
    ids = [int(r.value.split(",")[0]) for r in rows]
    assert ids == sorted(ids)
    # the reference-style order check on (partition, offset) finds nothing
    parsed = log.select("partition", "offset", F.split("value", ",").getItem(0).cast("int").alias("id"))
    assert order_violations(parsed, "id", position=("partition", "offset"), chunk_rows=7,
                            with_lines=False).count() == 0


def test_range_log_partitions_concatenate_to_total_order(spark, records_df, tmp_path):
    log = write_sorted_log(records_df(ROWS), "name", "name", _p(tmp_path, "rl"), num_ranges=5)
    rows = sorted(log.collect(), key=lambda r: (r.partition, r.offset))
    names = [r.value.split(",")[1] for r in rows]
    assert names == sorted(names) and len({r.partition for r in rows}) == 5
    assert all(r.key is None for r in rows)


def test_callback_sink_gets_sorted_rows_per_range(spark, records_df, tmp_path):
    acc = spark.sparkContext.accumulator(0)
    bad = spark.sparkContext.accumulator(0)

    def fn(it):
        prev = None
        for r in it:
            acc.add(1)
            if prev is not None and prev > r.id:
                bad.add(1)
            prev = r.id

    for_each_sorted_partition(total_sort(records_df(ROWS), "id"), fn)
    assert acc.value == 600 and bad.value == 0


def test_end_to_end(spark, tmp_path):
    report, metrics = run_end_to_end(spark, _p(tmp_path, "pipe"), n=3_000, seed=5, exact=True)
    rows = {(r.check, r.dataset): r for r in report.collect()}
    assert rows[("all", "*")].passed
    assert set(metrics) == {"id", "name", "continent"}
    src_ck = int(rows[("integrity", "source")].value)
    assert all(m["rows"] == 3_000 and m["checksum"] == src_ck for m in metrics.values())


def test_end_to_end_needs_input(spark, tmp_path):
    with pytest.raises(ValueError):
        run_end_to_end(spark, _p(tmp_path, "x"))


def test_range_files_map_each_range_to_its_own_files(spark, records_df, tmp_path):
    from sortproof.operators.sort import write_sorted
    from sortproof.sinks.log import range_files

    t = write_sorted(records_df(ROWS), "id", _p(tmp_path, "rf"), num_ranges=4)
    files = range_files(t)
    assert sorted(files) == [0, 1, 2, 3]
    for rid, paths in files.items():
        got = spark.read.parquet(*paths).select("range_id").distinct().collect()
        assert [r.range_id for r in got] == [rid]


def test_stream_to_callback(spark, records_df, tmp_path):
    from sortproof.operators.parse import parse_strict
    from sortproof.sinks.log import stream_to_callback
    from sortproof.sources.log import stream_log

    log = _p(tmp_path, "cb-log")
    write_keyed_log(records_df(ROWS).repartition(3), "source", log, num_partitions=2)
    seen = spark.sparkContext.accumulator(0)
    bad = spark.sparkContext.accumulator(0)

    def fn(it):
        prev = None
        for r in it:
            seen.add(1)
            if prev is not None and prev > r.id:
                bad.add(1)
            prev = r.id

    parsed = parse_strict(stream_log(spark, log, max_files_per_trigger=1))
    stream_to_callback(parsed, "id", fn, _p(tmp_path, "cb-ck"))
    assert seen.value == 600 and bad.value == 0


def test_kafka_options(spark):
    from sortproof.sinks.log import kafka_write_options
    from sortproof.sources.log import kafka_read_options

    r = kafka_read_options(spark, "b:9092", "source", {"kafka.fetch.min.bytes": "1"}, stream=False)
    assert r["kafka.bootstrap.servers"] == "b:9092" and r["subscribe"] == "source"
    assert r["startingOffsets"] == "earliest" and r["endingOffsets"] == "latest"
    assert int(r["minPartitions"]) == spark.sparkContext.defaultParallelism
    assert r["kafka.fetch.min.bytes"] == "1" and r["kafka.max.partition.fetch.bytes"] == "1048576"
    st = kafka_read_options(spark, "b:9092", "source", None, stream=True)
    assert "endingOffsets" not in st and int(st["maxOffsetsPerTrigger"]) > 0
    w = kafka_write_options("id", "b:9092", {"kafka.acks": "all"})
    assert w["topic"] == "id" and w["kafka.acks"] == "all" and w["kafka.compression.type"] == "zstd"
