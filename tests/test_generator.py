"""Synthetic record source."""

from pyspark.sql import functions as F

from sortproof.sources.generator import ADDRESS_CHARS, ALNUM, CONTINENTS, LETTERS, generate_records


def test_domains(spark):
    rows = generate_records(spark, 3_000, seed=42).collect()
    assert len(rows) == 3_000
    assert {r.continent for r in rows} == set(CONTINENTS)
    for r in rows:
        assert -(2**31) <= r.id < 2**31
        assert 10 <= len(r.name) <= 15 and set(r.name) <= set(LETTERS)
        assert 15 <= len(r.address) <= 20 and set(r.address) <= set(ADDRESS_CHARS)
        assert r.address[0] in ALNUM and r.address[-1] in ALNUM
    assert {len(r.name) for r in rows} == set(range(10, 16))
    assert {len(r.address) for r in rows} == set(range(15, 21))


def test_same_rows_for_any_partitioning(spark):
    a = generate_records(spark, 2_000, seed=7, num_partitions=1)
    b = generate_records(spark, 2_000, seed=7, num_partitions=16)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    c = generate_records(spark, 2_000, seed=8, num_partitions=4)
    assert a.exceptAll(c).count() > 1_900


def test_ids_spread(spark):
    df = generate_records(spark, 10_000, seed=1)
    r = df.agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.countDistinct("id").alias("d")).first()
    assert r.lo < -(2**30) and r.hi > 2**30 and r.d > 9_990
