"""The ``records`` view over the driver's TPC-H-style tables.

The test data has no record table of its own, so one record is derived per
``lineitem`` row:

* ``id``        = ``(l_orderkey * 2654435761) mod 2^32 - 2^31`` (signed spread,
  repeats allowed, computed without 64-bit overflow for any order key)
* ``name``      = ``p_name``
* ``address``   = ``l_linenumber || ' ' || p_brand || ' ' || p_type``
* ``continent`` = ``r_name`` of the supplier's region

The joins are fixture preparation, not an operator.  ``nation`` and
``region`` have 25 and 5 rows by definition of the schema, so their join is
broadcast; ``part`` and ``supplier`` grow with the data and are left to
Catalyst/AQE (broadcast only under the size threshold, else sort-merge).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed multiplier of the id spread (Knuth's multiplicative hash constant).
ID_SPREAD_MULTIPLIER = 2654435761


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread_id(orderkey: Column) -> Column:
    """``(k * 2654435761) mod 2^32 - 2^31`` as INT, overflow-free.

    k mod 2^32 is split in 16-bit halves so that no product exceeds 2^48.
    """
    k = ID_SPREAD_MULTIPLIER
    lo = orderkey.bitwiseAND(0xFFFF)
    hi = F.shiftright(orderkey, 16).bitwiseAND(0xFFFF)
    low32 = (lo * k + (hi * k).bitwiseAND(0xFFFF) * 0x10000).bitwiseAND(0xFFFFFFFF)
    return (low32 - (1 << 31)).cast("int")


def records_from_tables(
    spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()
) -> DataFrame:
    """The ``records`` view; ``extra`` keeps lineitem columns (e.g. for slicing)."""
    base = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    li = read_table(spark, sf_dir, "lineitem").select(*base, *[c for c in extra if c not in base])
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = F.broadcast(nation.join(region, nation.n_regionkey == region.r_regionkey))
    supplier_region = supplier.join(geo, supplier.s_nationkey == geo.n_nationkey).select(
        "s_suppkey", "r_name"
    )
    joined = li.join(part, li.l_partkey == part.p_partkey).join(
        supplier_region, li.l_suppkey == supplier_region.s_suppkey
    )
    return joined.select(
        spread_id(F.col("l_orderkey")).alias("id"),
        F.col("p_name").alias("name"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit(" "), F.col("p_brand"), F.lit(" "),
                 F.col("p_type")).alias("address"),
        F.col("r_name").alias("continent"),
        *[F.col(c) for c in extra],
    )


# The same view as DuckDB SQL, used by the oracle queries.
RECORDS_SQL = """
SELECT
  CAST((((l_orderkey & 65535) * 2654435761
        + ((((l_orderkey >> 16) & 65535) * 2654435761) & 65535) * 65536) & 4294967295)
       - 2147483648 AS INTEGER) AS id,
  p_name AS name,
  CAST(l_linenumber AS VARCHAR) || ' ' || p_brand || ' ' || p_type AS address,
  r_name AS continent,
  l_orderkey, l_linenumber
FROM lineitem
JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
"""
