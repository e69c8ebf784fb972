"""Connected components of a graph given as a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortproof.session import scratch_path, write_and_read


def _around(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.where(F.col("a") != F.col("b"))


def _stars(links: DataFrame) -> DataFrame:
    """One round: larger neighbours to the least one, then smaller neighbours to the least one."""
    both = _around(links)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    # now every link points from a node to a smaller one
    large = large.where(F.col("a") != F.col("b")).distinct()
    down = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b"))
    return small.unionByName(down.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, label`` for every node of the links ``a, b``; the label is the least node it reaches.

    Rounds are written tables in the shared folder; a round that changes
    nothing is the last (every node is then linked to its label only).  The
    number of rounds grows with the logarithm of the longest path.
    """
    spark = links.sparkSession
    current = write_and_read(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b")).distinct(),
        scratch_path(spark, "links"),
    )
    mark = None
    for _ in range(max_rounds):
        seen = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(seen) == mark or not seen[0]:
            labels = current.select(F.col("a").alias("node"), F.col("b").alias("label"))
            roots = current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            return labels.unionByName(roots)
        mark = tuple(seen)
        current = write_and_read(_stars(current), scratch_path(spark, "links"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
