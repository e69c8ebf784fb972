"""Streaming landing, running stats and the stateful order monitor."""

import random
import uuid

import pytest

from sortproof.operators.aggregate import count_and_checksum
from sortproof.schema import LOG_SCHEMA
from sortproof.sinks.log import write_keyed_log
from sortproof.sources.log import stream_log
from sortproof.streaming.jobs import land_and_sort, run_complete, run_order_monitor, stream_stats


def _p(tmp_path, name):
    return str(tmp_path / f"{name}-{uuid.uuid4().hex[:6]}")


def test_stream_stats_equal_batch(spark, records_df, tmp_path):
    rows = [(i * 13 % 97, f"n{i}", f"a {i}", "Asia") for i in range(500)]
    src = records_df(rows)
    log = _p(tmp_path, "log")
    write_keyed_log(src.repartition(5), "source", log, num_partitions=3)
    out = run_complete(stream_stats(stream_log(spark, log, max_files_per_trigger=2)), _p(tmp_path, "o"),
                       _p(tmp_path, "ck")).collect()
    batch = count_and_checksum(src).first()
    assert len(out) == 1 and out[0].n == batch.n == 500 and out[0].checksum == batch.checksum
    assert out[0].rejected == 0


def _write_log(spark, path, batches):
    # each batch: list of (partition, offset, id) -> one file per batch, in order;
    # an id of None writes an unparseable line
    for b in batches:
        rows = [(None, f"{i},n,a,c" if i is not None else "garbage", "t", p, o, None) for p, o, i in b]
        spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_order_monitor_finds_planted_violation(spark, tmp_path):
    log = _p(tmp_path, "mlog")
    _write_log(spark, log, [
        [(0, 0, 1), (0, 1, 2), (1, 0, 10)],
        [(0, 2, 3), (0, 3, 2), (1, 1, 11)],   # violation in partition 0 at position 4
        [(0, 4, 5), (1, 2, 9), (1, 3, None)],  # violation in partition 1 at position 3; bad line skipped
    ])
    res = run_order_monitor(stream_log(spark, log, max_files_per_trigger=1), _p(tmp_path, "mon"), _p(tmp_path, "ck"), "id")
    got = {r.partition: (r.n, r.rejected, r.violations, r.first_violation, r.offset_regressions) for r in res.collect()}
    # partition 1 starts with 10 after partition 0 has ended with 5
    assert got == {0: (5, 0, 1, 3, 0), 1: (3, 1, 1, 2, 0)}


def _monitor(spark, tmp_path, batches, **options):
    log = _p(tmp_path, "mlog")
    _write_log(spark, log, batches)
    res = run_order_monitor(stream_log(spark, log, max_files_per_trigger=1), _p(tmp_path, "mon"), _p(tmp_path, "ck"), **options)
    return {r.partition: (r.n, r.rejected, r.violations, r.first_violation, r.offset_regressions) for r in res.collect()}


def test_order_monitor_compares_partitions(spark, tmp_path):
    got = _monitor(spark, tmp_path, [[(0, 0, 10), (0, 1, 20), (1, 0, 1), (1, 1, 5)]])
    assert got == {0: (2, 0, 0, None, 0), 1: (2, 0, 1, 0, 0)}
    # a partition without one good line doesn't hide the break
    got = _monitor(spark, tmp_path, [[(0, 0, 10), (1, 0, None), (2, 0, 9)]])
    assert got == {0: (1, 0, 0, None, 0), 1: (0, 1, 0, None, 0), 2: (1, 0, 1, 0, 0)}


def test_late_file_of_a_sorted_log_is_no_violation(spark, tmp_path):
    got = _monitor(spark, tmp_path, [[(0, 0, 1), (0, 1, 2)], [(0, 4, 5), (0, 5, 6)], [(0, 2, 3), (0, 3, 4)]])
    assert got == {0: (6, 0, 0, None, 1)}


def test_order_monitor_small_chunks_against_brute_force(spark, tmp_path):
    rng = random.Random(3)
    ids = sorted(rng.randrange(500) for _ in range(400))
    for p in rng.sample(range(1, 400), 12):
        ids[p], ids[p - 1] = ids[p - 1], ids[p]
    rows = [(0, i, v) for i, v in enumerate(ids)]
    got = _monitor(spark, tmp_path, [rows[i : i + 90] for i in range(0, 400, 90)], chunk_rows=7)
    bad = [i for i in range(1, 400) if ids[i - 1] > ids[i]]
    assert got == {0: (400, 0, len(bad), bad[0], 0)}


def test_land_and_sort(spark, records_df, tmp_path):
    rows = [(i * 7 % 50, f"n{i}", "a", "c") for i in range(200)]
    log = _p(tmp_path, "log")
    write_keyed_log(records_df(rows).repartition(4), "source", log, num_partitions=2)
    t = land_and_sort(stream_log(spark, log, max_files_per_trigger=1), _p(tmp_path, "land"),
                      _p(tmp_path, "ck"), "id", _p(tmp_path, "sorted"))
    got = [r.id for r in t.orderBy("range_id", "offset").collect()]
    assert got == sorted(r[0] for r in rows)


def test_empty_stream_gives_empty_results(spark, tmp_path):
    log = _p(tmp_path, "empty")
    spark.createDataFrame([], LOG_SCHEMA).write.parquet(log)
    stats = run_complete(stream_stats(stream_log(spark, log)), _p(tmp_path, "o"), _p(tmp_path, "ck"))
    assert stats.count() == 0
    assert run_order_monitor(stream_log(spark, log), _p(tmp_path, "m"), _p(tmp_path, "ck2")).count() == 0
    t = land_and_sort(stream_log(spark, log), _p(tmp_path, "l"), _p(tmp_path, "ck3"), "id", _p(tmp_path, "s"))
    assert t.count() == 0
    t, rejects = land_and_sort(stream_log(spark, log), _p(tmp_path, "l"), _p(tmp_path, "ck4"), "id", _p(tmp_path, "s"),
                               mode="quarantine")
    assert t.count() == rejects.count() == 0


def test_drain_appends_everything_then_stops(spark, records_df, tmp_path):
    from sortproof.streaming.jobs import drain

    log = _p(tmp_path, "dlog")
    write_keyed_log(records_df([(i, "n", "a", "c") for i in range(300)]).repartition(3), "source", log, 2)
    out, ck = _p(tmp_path, "dout"), _p(tmp_path, "dck")
    t = drain(stream_log(spark, log, max_files_per_trigger=1), out, ck)
    assert t.count() == 300
    # a second drain with the same checkpoint finds nothing new
    assert drain(stream_log(spark, log, max_files_per_trigger=1), out, ck).count() == 300


def test_bad_lines_fail_or_go_to_quarantine(spark, tmp_path):
    log = _p(tmp_path, "log")
    _write_log(spark, log, [[(0, 0, 3), (0, 1, None)], [(0, 2, 1)]])
    with pytest.raises(Exception, match="Bad record line"):
        land_and_sort(stream_log(spark, log), _p(tmp_path, "l"), _p(tmp_path, "ck"), "id", _p(tmp_path, "s"))
    t, rejects = land_and_sort(stream_log(spark, log), _p(tmp_path, "l"), _p(tmp_path, "ck"), "id", _p(tmp_path, "s"),
                               mode="quarantine")
    assert [r.id for r in t.orderBy("range_id", "offset").collect()] == [1, 3]
    assert [tuple(r) for r in rejects.collect()] == [("garbage", "FIELD_COUNT")]
    with pytest.raises(ValueError, match="mode"):
        land_and_sort(stream_log(spark, log), "x", "y", "id", "z", mode="skip")


def test_only_a_missing_table_counts_as_empty(spark, tmp_path):
    from sortproof.streaming.jobs import _read_or_empty

    assert _read_or_empty(spark, str(tmp_path / "none"), LOG_SCHEMA).count() == 0
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):
        _read_or_empty(spark, str(tmp_path), LOG_SCHEMA, "no.such.format")


def test_monitor_state_is_bounded_and_restarts(spark, tmp_path):
    from sortproof.streaming.jobs import Snapshots

    rng = random.Random(8)
    ids = sorted(rng.randrange(900) for _ in range(600))
    for p in rng.sample(range(1, 600), 20):
        ids[p], ids[p - 1] = ids[p - 1], ids[p]
    rows = [(0, i, None if i % 83 == 5 else v) for i, v in enumerate(ids)]
    good = [(o, v) for _, o, v in rows if v is not None]
    bad = [b[0] for a, b in zip(good, good[1:]) if a[1] > b[1]]
    want = {0: (len(good), 600 - len(good), len(bad), bad[0])}
    for order in ("in order", "shuffled"):
        log, states, ckpt = (_p(tmp_path, n) for n in ("log", "state", "ck"))
        batches = [rows[i : i + 25] for i in range(0, 600, 25)]
        if order == "shuffled":
            rng.shuffle(batches)
        for part in (batches[:7], batches[7:20], batches[20:]):  # a run, and two that go on
            _write_log(spark, log, part)
            res = run_order_monitor(stream_log(spark, log, max_files_per_trigger=4), states, ckpt, "id", chunk_rows=10,
                                    most_stretches=40)
        got = {r.partition: (r.n, r.rejected, r.violations, r.first_violation) for r in res.collect()}
        assert got == want, order
        snapshots = Snapshots(spark, states)
        assert snapshots.latest().count() == 1 and len(snapshots._versions()) == 2
        # the last micro-batch once more: the version before it is still there, and the result is the same
        before, last = sorted(snapshots._versions())
        assert snapshots.latest(before=last).count() >= 1 and before < last


def test_a_retried_epoch_replaces_its_version(spark, tmp_path):
    from sortproof.streaming.jobs import Snapshots, _batch_chunks, fold_stretches, order_state

    def chunks(*rows):
        log = spark.createDataFrame([(None, f"{i},n,a,c", "t", 0, o, None) for o, i in rows], LOG_SCHEMA)
        return _batch_chunks(log, "id", True, 1 << 20, False)

    states = Snapshots(spark, _p(tmp_path, "state"))
    states.put(0, fold_stretches(states.latest(before=0), chunks((0, 1), (1, 5)), True))
    for _ in range(2):
        states.put(1, fold_stretches(states.latest(before=1), chunks((2, 4), (3, 9)), True))
    r = order_state(states.latest()).first()
    assert (r.n, r.violations, r.first_violation, r.offset_regressions) == (4, 1, 2, 0)


def test_too_many_stretches_are_joined_from_below(spark, tmp_path):
    from sortproof.streaming.jobs import Snapshots

    log, states = _p(tmp_path, "log"), _p(tmp_path, "state")
    _write_log(spark, log, [[(0, 10 * i, i if i != 7 else 0)] for i in range(12)])  # gaps between all offsets
    res = run_order_monitor(stream_log(spark, log, max_files_per_trigger=1), states, _p(tmp_path, "ck"), "id", most_stretches=3)
    r = res.first()
    assert (r.n, r.violations, r.first_violation, r.offset_regressions) == (12, 1, 70, 0)
    assert Snapshots(spark, states).latest().count() == 3
