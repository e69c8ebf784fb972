"""Logs that are appended to, stretches of them, and deliveries that count once."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from sortproof.operators.parse import parse_strict
from sortproof.operators.sort import write_sorted
from sortproof.schema import LOG_SCHEMA
from sortproof.sinks import log as L
from sortproof.sinks.ledger import ConcurrentAppend, Folder, Ledger
from sortproof.sinks.once import OnceFiles
from sortproof.sources.log import files_of_stretch, kafka_read_options, read_log, stream_log
from sortproof.streaming.jobs import drain


def _p(tmp_path, name):
    return str(tmp_path / f"{name}-{uuid.uuid4().hex[:6]}")


def rows(a, b):
    return [(i * 37 % 211, f"n{i}", f"a{i}", "Asia") for i in range(a, b)]


def check_dense(log, n):
    got = log.select("partition", "offset").collect()
    per = {}
    for r in got:
        per.setdefault(r["partition"], []).append(r["offset"])
    assert len(got) == n and all(sorted(o) == list(range(len(o))) for o in per.values())
    return per


def test_appends_go_on_densely(spark, records_df, tmp_path):
    path = _p(tmp_path, "log")
    first = L.append_keyed_log(records_df(rows(0, 300)).repartition(5), "t", path, 3)
    assert first.count() == 300 and first.columns == LOG_SCHEMA.fieldNames()
    ends = Ledger(spark, path).next_offsets("t")
    second = L.append_keyed_log(records_df(rows(300, 400)).repartition(2), "t", path, 3)
    assert second.count() == 100 and {r.value.split(",")[1] for r in second.collect()} == {f"n{i}" for i in range(300, 400)}
    per = check_dense(read_log(spark, path, "t"), 400)
    assert {p: len(o) for p, o in per.items()} == Ledger(spark, path).next_offsets("t")
    # same key, same partition, over both appends; another topic counts for itself
    keys = read_log(spark, path).groupBy("key").agg(F.count_distinct("partition").alias("d")).filter("d > 1")
    assert keys.count() == 0 and sum(ends.values()) == 300
    L.append_keyed_log(records_df(rows(0, 10)), "u", path, 2)
    check_dense(read_log(spark, path, "u"), 10)
    check_dense(read_log(spark, path, "t"), 400)
    assert L.append_keyed_log(records_df([]), "t", path, 3).count() == 0
    check_dense(read_log(spark, path, "t"), 400)


def test_a_stretch_reads_only_its_files(spark, records_df, tmp_path):
    path, ends = _p(tmp_path, "log"), []
    for i in range(3):
        L.append_keyed_log(records_df(rows(100 * i, 100 * i + 100)).repartition(3), "t", path, 3)
        ends.append(Ledger(spark, path).next_offsets("t"))
    mid = read_log(spark, path, "t", from_offsets=ends[0], to_offsets=ends[1])
    assert {r.value.split(",")[1] for r in mid.collect()} == {f"n{i}" for i in range(100, 200)}
    files = files_of_stretch(spark, path, "t", ends[0], ends[1])
    everything = [f for f in os.listdir(path) if f.startswith("part-")]
    assert 0 < len(files) < len(everything) and len(mid.inputFiles()) == len(files)
    plan = mid._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "offset" in plan.split("PushedFilters")[1]
    # one partition's bound leaves the others whole; beyond the end there is nothing
    p = max(ends[2], key=ends[2].get)
    part = read_log(spark, path, "t", from_offsets={p: 5}, to_offsets={p: 8})
    assert part.filter(F.col("partition") == p).count() == 3 and part.count() == 300 - ends[2][p] + 3
    assert read_log(spark, path, "t", from_offsets=ends[2]).count() == 0
    # a log without a ledger: the filter alone
    plain = _p(tmp_path, "plain")
    read_log(spark, path, "t").write.parquet(plain)
    assert files_of_stretch(spark, plain, "t", ends[0], ends[1]) is None
    assert read_log(spark, plain, "t", from_offsets=ends[0], to_offsets=ends[1]).count() == 100


def test_a_stream_sees_only_what_is_new(spark, records_df, tmp_path):
    path, out, ckpt = (_p(tmp_path, n) for n in ("log", "out", "ckpt"))
    L.append_keyed_log(records_df(rows(0, 50)), "t", path, 2)
    assert drain(stream_log(spark, path, "t"), out, ckpt).count() == 50
    L.append_keyed_log(records_df(rows(50, 70)), "t", path, 2)
    check_dense(drain(stream_log(spark, path, "t"), out, ckpt), 70)


def test_an_append_that_died_is_finished_or_forgotten(spark, records_df, tmp_path, monkeypatch):
    path = _p(tmp_path, "log")
    L.append_keyed_log(records_df(rows(0, 40)), "t", path, 2)
    # dies after it counts, with no file moved
    finish = Ledger._finish
    monkeypatch.setattr(Ledger, "_finish", lambda self, version: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        L.append_keyed_log(records_df(rows(40, 60)), "t", path, 2)
    monkeypatch.setattr(Ledger, "_finish", finish)
    assert read_log(spark, path, "t").count() == 40
    assert Ledger(spark, path).recover() == [2] and Ledger(spark, path).recover() == []
    check_dense(read_log(spark, path, "t"), 60)
    # dies before it counts: nothing of it is seen, and its offsets are given to the next one
    monkeypatch.setattr(Ledger, "commit", lambda self, *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        L.append_keyed_log(records_df(rows(60, 80)), "t", path, 2)
    monkeypatch.undo()
    L.append_keyed_log(records_df(rows(80, 90)), "t", path, 2)
    check_dense(read_log(spark, path, "t"), 70)
    assert read_log(spark, path, "t", from_offsets={0: 0, 1: 0}).count() == 70


def test_two_appends_at_once_fail(spark, records_df, tmp_path, monkeypatch):
    path = _p(tmp_path, "log")
    commit = Ledger.commit

    def late(self, *a):
        monkeypatch.setattr(Ledger, "commit", commit)
        L.append_keyed_log(records_df(rows(0, 5)), "t", path, 2)  # another one comes first
        commit(self, *a)

    monkeypatch.setattr(Ledger, "commit", late)
    with pytest.raises(ConcurrentAppend):
        L.append_keyed_log(records_df(rows(5, 9)), "t", path, 2)
    check_dense(read_log(spark, path, "t"), 5)
    folder = Folder(spark, path)
    assert folder.create("_ledger/x", "1") and not folder.create("_ledger/x", "2") and folder.read("_ledger/x") == "1"


def test_kafka_offsets(spark, monkeypatch):
    from sortproof.sources import log as SL

    seen = {}
    monkeypatch.setattr(SL, "kafka_read_options", lambda s, b, t, o, stream: seen.update(o) or (_ for _ in ()).throw(KeyError()))
    with pytest.raises(KeyError):
        read_log(spark, topic="t", bootstrap_servers="b:1", from_offsets={0: 5}, to_offsets={0: 9, 1: 4})
    assert json.loads(seen["startingOffsets"]) == {"t": {"0": 5, "1": -2}}
    assert json.loads(seen["endingOffsets"]) == {"t": {"0": 9, "1": 4}}
    monkeypatch.undo()
    opts = kafka_read_options(spark, "b:1", "t", seen, stream=False)
    assert json.loads(opts["startingOffsets"])["t"]["0"] == 5


def test_ranges_are_pushed_in_order_with_their_tokens(spark, records_df, tmp_path):
    table = write_sorted(records_df(rows(0, 300)), "name", _p(tmp_path, "s"), num_ranges=4)
    out = OnceFiles(_p(tmp_path, "out"))

    def take(token, part):
        names = [r.name for r in part]
        assert names == sorted(names)
        if not out.has(token):
            out.put(token, "\n".join(names).encode())

    for _ in range(2):  # pushed again, every token finds itself done
        L.for_each_range(table, take, "e")
    got = [out.get(t).decode().split("\n") for t in out.tokens()]
    assert out.tokens() == [f"e-{i:06d}" for i in range(4)] and sorted(sum(got, [])) == sum(got, []) and len(sum(got, [])) == 300
    L.for_each_range(table.limit(0), take, "none")


def test_a_stream_that_fails_delivers_once(spark, records_df, tmp_path):
    log, out, tries = _p(tmp_path, "log"), OnceFiles(_p(tmp_path, "out")), OnceFiles(_p(tmp_path, "tries"))
    L.append_keyed_log(records_df(rows(0, 200)).repartition(4), "t", log, 2)
    own = {"checkpoint": _p(tmp_path, "ckpt"), "ranges": _p(tmp_path, "ranges")}

    def take(token, part):
        again = tries.has(token)
        tries.put(token, b"")
        values = [r.name for r in part]
        if token.endswith("-000000") and not again:
            raise RuntimeError("on purpose")
        if not out.has(token):
            out.put(token, "\n".join(values).encode())

    with pytest.raises(Exception, match="on purpose"):
        L.stream_to_callback(parse_strict(stream_log(spark, log)), "name", take, **own)
    before = {t: out.get(t) for t in out.tokens()}
    L.stream_to_callback(parse_strict(stream_log(spark, log)), "name", take, **own)
    assert all(out.get(t) == v for t, v in before.items())  # the same rows under the same token
    values = [v for t in out.tokens() for v in out.get(t).decode().split("\n") if v]
    assert len(values) == 200 and len(set(values)) == 200
