"""Sorts, chunks, merges, ranks (mirrors the reference's run writer/merger tests)."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sortproof.functions.cutting import cut_batch
from sortproof.functions.record import size_estimate
from sortproof.operators.sort import (
    global_rank,
    merge_sorted,
    order_spec,
    rank_records,
    range_sort,
    sorted_chunks,
    total_sort,
    with_positions,
    write_sorted,
)
from sortproof.operators.verify import chunk_check
from sortproof.sinks.log import read_run_groups, read_runs, write_runs
from sortproof.sources.log import read_lines


def seeded_rows(n, seed, id_bound, name_fmt, addr_fmt, cont_mod):
    rng = random.Random(seed)
    return [(rng.randrange(id_bound), name_fmt.format(i), addr_fmt.format(i), f"Continent_{i % cont_mod}")
            for i in range(n)]


def is_sorted(rows, key=lambda r: r[0]):
    return all(key(a) <= key(b) for a, b in zip(rows, rows[1:]))


def test_chunks_small_budget(spark, records_df, tmp_path):
    rows = seeded_rows(10_000, 42, 1_000_000, "Name_{}", "Address_{} Street", 7)
    write_runs(records_df(rows).coalesce(1), "id", str(tmp_path / "runs"), budget_bytes=51_200)
    runs = read_runs(spark, str(tmp_path / "runs"))
    per = chunk_check(runs, "id").collect()
    assert sum(r.rows for r in per) == 10_000 and all(r.violations == 0 and r.rows > 0 for r in per)
    # the reference's rule: the row that reaches the budget ends the chunk
    expect, held = [0], 0
    for r in rows:
        if held >= 51_200:
            expect, held = [*expect, 0], 0
        expect[-1] += 1
        held += 44 + 2 * sum(map(len, r[1:]))
    by_run = sorted((int(r.chunk.split("/")[0]), r.rows) for r in per)
    assert [n for _, n in by_run] == expect and len(expect) >= 2


def test_chunks_large_budget_and_one_chunk(spark, records_df, tmp_path):
    df = records_df(seeded_rows(5_000, 99, 500_000, "Person_{}", "Addr_{}", 5)).coalesce(1)
    rows = sorted_chunks(df, "id", budget_bytes=157_286_400).collect()
    assert {r.run for r in rows} == {0} and len(rows) == 5_000 and is_sorted([tuple(r) for r in rows])
    small = records_df([(500 - i, "n", "a", "c") for i in range(500)]).coalesce(1)
    assert [r.id for r in sorted_chunks(small, "id", budget_bytes=157_286_400).collect()] == list(range(1, 501))


def test_many_chunks_zero_padded_names(spark, records_df, tmp_path):
    df = records_df([(i, "N", "A", "C") for i in range(100)]).coalesce(1)
    write_runs(df, "id", str(tmp_path / "r"), budget_bytes=200, fmt="text")  # 50 bytes a row
    names = sorted(f.name for f in (tmp_path / "r").rglob("part-*"))
    assert len(names) == 25 and all(f[5:10].isdigit() for f in names)
    assert read_lines(spark, str(tmp_path / "r")).count() == 100


def test_chunks_of_planted_sizes_keep_to_the_budget(spark, records_df, tmp_path):
    # 15,000 short rows, then 5,000 long ones: a mean row size would cut badly
    rows = [(i, "n", "a" if i < 15_000 else "a" * 400, "c") for i in range(20_000)]
    for parts in (1, 3):
        path = str(tmp_path / f"runs{parts}")
        write_runs(records_df(rows).coalesce(parts), "id", path, budget_bytes=262_144)
        per = read_runs(spark, path).groupBy("chunk").agg(F.sum(size_estimate()).alias("b"), F.max(size_estimate()).alias("w")).collect()
        assert all(r.b - r.w < 262_144 for r in per)
        assert sum(r.b < 262_144 for r in per) <= max(parts, records_df(rows).coalesce(parts).rdd.getNumPartitions())


@pytest.mark.parametrize("batch", [1, 3, 50, 1000])
def test_cuts_do_not_depend_on_batches(batch):
    rng = random.Random(batch)
    sizes = [rng.choice([0, 1, 5, 30, 400]) for _ in range(700)]
    whole, _, _ = cut_batch(np.array(sizes), 0, 100)
    got, done, held = [], 0, 0
    for i in range(0, len(sizes), batch):
        before, closed, held = cut_batch(np.array(sizes[i : i + batch]), held, 100)
        got += (before + done).tolist()
        done += closed
    assert got == whole.tolist()
    for c in range(max(got)):  # all but the last: at the budget, and not before the last row
        own = [s for s, g in zip(sizes, got, strict=True) if g == c]
        assert sum(own) >= 100 and sum(own[:-1]) < 100
    assert cut_batch(np.zeros(0, int), 7, 100)[1:] == (0, 7)


def test_chunks_are_cut_without_a_shuffle(spark, records_df):
    df = records_df(seeded_rows(1_000, 1, 500, "N{}", "A{}", 3)).repartition(3)
    assert sorted_chunks(df, "id", chunk_rows=70).count() == 1_000
    src = spark.range(9).selectExpr("int(id) as id", "'' as name", "'' as address", "'' as continent")
    for own in (sorted_chunks(src, "id", chunk_rows=4), sorted_chunks(src, "id", 100)):
        assert "Exchange" not in own._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="positive"):
        sorted_chunks(df, "id", 0)


def test_empty_input(spark, records_df):
    assert sorted_chunks(records_df([]), "id", budget_bytes=1000).count() == 0


def merge_inputs(records_df, k, per_file):
    return [records_df([(f + j * k, f"Name_{f + j * k}", f"Address_{f + j * k}", f"Continent_{(f + j * k) % 7}")
                        for j in range(per_file)]) for f in range(k)]


@pytest.mark.parametrize("k,per_file", [(5, 200), (10, 150), (1, 300), (8, 100)])
def test_merge_k_inputs(spark, records_df, k, per_file):
    out = merge_sorted(spark, [total_sort(d, "id") for d in merge_inputs(records_df, k, per_file)], "id")
    rows = sorted(out.collect(), key=lambda r: r.pos)
    assert [r.pos for r in rows] == list(range(1, k * per_file + 1))
    assert [r.id for r in rows] == list(range(k * per_file))


def test_merge_empties(spark, records_df):
    assert merge_sorted(spark, [records_df([])], "id").count() == 0
    assert merge_sorted(spark, [], "id").count() == 0


def test_merge_duplicates(spark, records_df):
    one = records_df([(i, f"Name_{i}", f"Addr_{i}", f"C_{i % 5}") for i in range(1, 51)])
    out = sorted(merge_sorted(spark, [one, one], "id").collect(), key=lambda r: r.pos)
    assert len(out) == 100 and is_sorted([r.id for r in out], key=lambda x: x)


def test_order_spec_names_and_errors():
    assert order_spec("Name")[0] == ("name", True)
    assert order_spec("CONTINENT")[:2] == [("continent", True), ("id", True)]
    assert order_spec(["-continent", "name"])[:2] == [("continent", False), ("name", True)]
    with pytest.raises(ValueError, match="the columns are"):
        order_spec("zip")
    with pytest.raises(ValueError):
        order_spec("  ")


def test_rank_is_total_order(spark, records_df):
    rows = seeded_rows(3_000, 7, 100, "n{}", "a{}", 3) * 2  # many ties, full duplicates
    ranked = rank_records(records_df(rows), "continent").collect()
    assert sorted(r.pos for r in ranked) == list(range(1, len(rows) + 1))
    by_pos = [(r.continent, r.id, r.name, r.address) for r in sorted(ranked, key=lambda r: r.pos)]
    assert by_pos == sorted(by_pos)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_rank_invariant_to_partitioning(spark, records_df, parts):
    rows = seeded_rows(2_000, 3, 50, "n{}", "a{}", 4)
    ranked = rank_records(records_df(rows).repartition(parts), "name")
    got = {(r.id, r.name, r.address, r.continent): r.pos for r in ranked.collect()}
    expect = {k: i + 1 for i, k in enumerate(sorted(rows, key=lambda r: (r[1], r[0], r[2], r[3])))}
    assert got == expect


def test_low_cardinality_key_fills_all_ranges(spark, records_df, tmp_path):
    rows = seeded_rows(8_000, 5, 10**6, "n{}", "a{}", 6)
    df = records_df(rows)
    t = write_sorted(df, "continent", str(tmp_path / "s"), num_ranges=8)
    sizes = [r["count"] for r in t.groupBy("range_id").count().collect()]
    assert len(sizes) == 8 and min(sizes) > 0


def test_range_sort_ranges_are_ordered(spark, records_df, tmp_path):
    df = records_df(seeded_rows(4_000, 11, 10**6, "n{}", "a{}", 3))
    with_positions(range_sort(df, "id", 6)).write.parquet(str(tmp_path / "r"))
    t = spark.read.parquet(str(tmp_path / "r"))
    bounds = t.groupBy("range_id").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).orderBy("range_id").collect()
    assert all(a.hi <= b.lo for a, b in zip(bounds, bounds[1:]))
    ranked = global_rank(t).orderBy("pos").collect()
    assert is_sorted([r.id for r in ranked], key=lambda x: x)


def test_java_string_order(spark):
    df = spark.createDataFrame([(1, "￮", "", ""), (2, "\U0001F600", "", "")],
                               "id int, name string, address string, continent string")
    spark_order = [r.id for r in total_sort(df, "name").collect()]
    java_order = [r.id for r in total_sort(df, "name", java_string_order=True).collect()]
    assert spark_order == [1, 2] and java_order == [2, 1]


def test_identical_copies_do_not_make_a_hot_range(spark, tmp_path):
    # a third of all rows is one repeated record
    hot = spark.range(9_000).select(F.lit(7).cast("int").alias("id"), F.lit("same").alias("name"),
                                    F.lit("a").alias("address"), F.lit("Asia").alias("continent"))
    rest = spark.range(18_000).select((F.col("id") % 1000).cast("int").alias("id"),
                                      F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"),
                                      F.lit("b").alias("address"), F.lit("Europe").alias("continent"))
    t = write_sorted(hot.unionByName(rest), "id", str(tmp_path / "s"), num_ranges=8)
    sizes = [r["count"] for r in t.groupBy("range_id").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 27_000 / 8
    ranked = global_rank(t)
    assert ranked.agg(F.countDistinct("pos")).first()[0] == 27_000


def test_copies_of_one_landed_file_spread_over_ranges(spark, tmp_path):
    df = spark.range(60_000).selectExpr("int(1) as id", "'n' as name", "'a' as address", "'c' as continent").coalesce(1)
    df.write.parquet(str(tmp_path / "landed"))
    landed = spark.read.parquet(str(tmp_path / "landed"))
    t = write_sorted(landed, "id", str(tmp_path / "s"), num_ranges=6, stable_input=True)
    sizes = [r["count"] for r in t.groupBy("range_id").count().collect()]
    assert sum(sizes) == 60_000 and len(sizes) >= 5 and max(sizes) < 20_000
    ranks = global_rank(t).selectExpr("count(distinct pos) as n", "max(pos) as m").first()
    assert (ranks["n"], ranks["m"]) == (60_000, 60_000)


def test_run_groups_hold_every_file_once(spark, records_df, tmp_path):
    rows = [(i, "n", "a" * (i % 90), "c") for i in range(900)]
    path = str(tmp_path / "runs")
    write_runs(records_df(rows).repartition(3), "id", path, budget_bytes=2_000)
    whole = sorted(map(tuple, read_runs(spark, path).collect()))
    groups = list(read_run_groups(spark, path, files_at_once=12))
    lists = [set(g.inputFiles()) for g in groups]
    assert len(groups) > 5 and max(map(len, lists)) <= 12
    assert sum(map(len, lists)) == len(set().union(*lists)) == len(read_runs(spark, path).inputFiles())
    assert sorted(tuple(r) for g in groups for r in g.collect()) == whole
    assert len(list(read_run_groups(spark, path))) == 1


def test_short_chunks_are_judged_by_the_partitions_that_were_cut(spark):
    from sortproof.plans import queries

    # without its wide column the view falls into one partition, with it into several
    conf = {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        wide = F.concat(*[F.sha2(F.concat("id", F.lit(f"x{i}")), 512) for i in range(20)])
        planted = spark.range(3_000).selectExpr("int(id) AS id", "'n' AS name", "'c' AS continent").withColumn("address", wide)
        r = queries._chunk_report(spark, planted.repartition("id").select("id", "name", "address", "continent")).first()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert (r["rows"], r.violations, r.over_budget, r.too_many_short, r.least, r.greatest) == (3_000, 0, 0, False, 0, 2_999)


def test_a_short_chunk_before_the_last_is_reported(spark, records_df, monkeypatch):
    from sortproof.plans import queries

    rows = [(i, "n", "a" * 500, "c") for i in range(40)]
    write = queries.write_runs
    monkeypatch.setattr(queries, "CHUNK_BUDGET", 10_000)
    assert not queries._chunk_report(spark, records_df(rows).coalesce(1)).first().too_many_short
    monkeypatch.setattr(queries, "write_runs", lambda df, key, path, budget: write(df, key, path, budget // 2))
    assert queries._chunk_report(spark, records_df(rows).coalesce(1)).first().too_many_short
