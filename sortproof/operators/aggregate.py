"""Counts and checksums of record datasets.

Every aggregate is a hash aggregation with a partial (map-side) step, so
even a dataset holding most of the rows reduces to one row per task before
the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sortproof.functions.record import row_hash, size_estimate, wide_sum, wrapping_sum
from sortproof.schema import RECORD_COLUMNS


def count_and_checksum(df: DataFrame, impl: str = "jvm") -> DataFrame:
    """One row ``(n, checksum)``: row count and wrapping sum of row hashes (A1, A2)."""
    return df.select(row_hash(impl=impl).alias("_h")).agg(
        F.count(F.lit(1)).alias("n"), wrapping_sum("_h").alias("checksum")
    )


def dataset_stats(datasets: dict[str, DataFrame], impl: str = "jvm") -> DataFrame:
    """``(dataset, n, checksum)`` for several datasets in one job (A3).

    The datasets are tagged and unioned; one grouped aggregation computes
    all counts and checksums.  Every record carries a 1 that is summed, so a
    record counts whatever its fields hold; ``null_rows`` is the number of
    records with a null field (their hash is null and not in the checksum).
    A marker row with a 0 makes an empty dataset show up with ``n = 0``.
    """
    if not datasets:
        raise ValueError("no datasets given")
    parts = []
    for name, df in datasets.items():
        has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in RECORD_COLUMNS])
        parts.append(df.select(F.lit(name).alias("dataset"), row_hash(impl=impl).alias("_h"),
                               F.lit(1).alias("_one"), has_null.cast("int").alias("_null")))
    spark = next(iter(datasets.values())).sparkSession
    markers = spark.createDataFrame([(n,) for n in datasets], "dataset string").select(
        "dataset", F.lit(None).cast("bigint").alias("_h"), F.lit(0).alias("_one"), F.lit(0).alias("_null")
    )
    tagged = reduce(lambda a, b: a.unionByName(b), parts + [markers])
    return tagged.groupBy("dataset").agg(
        F.sum("_one").cast("bigint").alias("n"), wrapping_sum("_h").alias("checksum"),
        F.sum("_null").cast("bigint").alias("null_rows"),
    )


def counts_all_equal(stats: DataFrame) -> DataFrame:
    """One row ``all_equal``: every dataset has the same count (A4)."""
    return stats.agg((F.count_distinct("n") == 1).alias("all_equal"))


def estimated_bytes(df: DataFrame) -> DataFrame:
    """One row ``bytes``: estimated in-memory size of all records (A5)."""
    return df.agg(F.coalesce(F.sum(size_estimate()), F.lit(0)).cast("bigint").alias("bytes"))


def observe_records(df: DataFrame, name: str = "records", impl: str = "jvm") -> tuple[DataFrame, Observation]:
    """Attach count and checksum metrics to whatever action runs on ``df``.

    The metrics come from the same job (e.g. the write of a sorted output);
    no extra scan.  Read them with :func:`observed_metrics` after the action.
    """
    obs = Observation(name)
    hashed = df.withColumn("_h", row_hash(impl=impl))
    observed = hashed.observe(
        obs, F.count(F.lit(1)).alias("rows"), wide_sum("_h").alias("checksum_sum")
    )
    return observed.drop("_h"), obs


def observed_metrics(obs: Observation) -> dict:
    """``{"rows": int, "checksum": int}`` of a finished observed action."""
    m = obs.get
    total = int(m.get("checksum_sum") or 0)
    wrapped = ((total + (1 << 63)) % (1 << 64)) - (1 << 63)
    return {"rows": int(m.get("rows") or 0), "checksum": wrapped}
