"""Synthetic record source.

Every field is a pure function of ``(seed, row)``: the output is the same
for any partitioning and any retry (``rand(seed)`` is not), and the recipe is
plain SQL integer arithmetic inside whole-stage codegen, reproducible in
DuckDB (the oracle runs the same template).

Randomness: a 32-bit integer mixing hash, ``x = ((x >> 16) ^ x) * 0x45d9f3b``
twice then ``(x >> 16) ^ x``, all modulo 2^32 (products stay below 2^59, so
BIGINT never overflows).  The row is hashed once; every drawn value
``j`` is the hash of ``row_hash + j * 0x9E3779B1``.  Characters are
``value mod len(alphabet)``; lengths and the continent likewise.

Domains follow the reference: id uniform over int32; name 10-15 letters;
address 15-20 characters from letters, digits and spaces, never a space at
either end; continent one of six names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values: the generated domain (must stay as they are) ----
CONTINENTS = ["Africa", "Asia", "Australia", "Europe", "North America", "South America"]
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
ADDRESS_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789    "
NAME_LEN = (10, 15)
ADDRESS_LEN = (15, 20)
# --------------------------------------------------------------------

_M32 = 0xFFFFFFFF
_MUL = 0x45D9F3B
_GOLD = 0x9E3779B1

# drawn values, in order: (column, purpose)
_DRAWS = (
    ["_id", "_nlen", "_alen", "_cont", "_afirst", "_alast"]
    + [f"_n{i}" for i in range(NAME_LEN[1])]
    + [f"_m{i}" for i in range(ADDRESS_LEN[1] - 2)]
)


class _Dialect:
    def __init__(self, spark: bool):
        self.spark = spark

    def shr(self, x: str, n: int) -> str:
        return f"shiftright({x}, {n})" if self.spark else f"({x} >> {n})"

    def xor(self, a: str, b: str) -> str:
        return f"({a} ^ {b})" if self.spark else f"xor({a}, {b})"

    def round_(self, x: str) -> str:
        return f"(({self.xor(self.shr(x, 16), x)} * {_MUL}) & {_M32})"

    def final(self, x: str) -> str:
        return self.xor(self.shr(x, 16), x)


def _stages(row: str, seed: int, d: _Dialect) -> list[list[tuple[str, str]]]:
    """Successive projections ``[(name, sql), ...]``; each references the previous one."""
    seed_mix = (seed * _GOLD) & _M32
    s0 = [("_x", f"({d.xor(d.xor(f'({row} & {_M32})', d.shr(row, 32)), str(seed_mix))} & {_M32})")]
    s1 = [("_x", d.round_("_x"))]
    s2 = [("_x", d.round_("_x"))]
    s3 = [("_hrow", d.final("_x"))]
    t0 = [(v, f"((_hrow + {(j + 1) * _GOLD & _M32}) & {_M32})") for j, v in enumerate(_DRAWS)]
    t1 = [(v, d.round_(v)) for v in _DRAWS]
    t2 = [(v, d.round_(v)) for v in _DRAWS]
    t3 = [(v, d.final(v)) for v in _DRAWS]
    # digits in their own projection: the character expressions below then
    # stay small enough for the JIT (repeating `v % n` inside every CASE made
    # the fused code several times slower)
    t4 = [(v, f"CAST({v} % {_BASE[v]} AS INTEGER)") for v in _DRAWS if v != "_id"]
    return [s0, s1, s2, s3, t0, t1, t2, t3, t4]


_BASE = {
    "_nlen": NAME_LEN[1] - NAME_LEN[0] + 1,
    "_alen": ADDRESS_LEN[1] - ADDRESS_LEN[0] + 1,
    "_cont": len(CONTINENTS),
    "_afirst": len(ALNUM),
    "_alast": len(ALNUM),
    **{f"_n{i}": len(LETTERS) for i in range(NAME_LEN[1])},
    **{f"_m{i}": len(ADDRESS_CHARS) for i in range(ADDRESS_LEN[1] - 2)},
}


def _char(alphabet: str, v: str) -> str:
    """``alphabet[v]`` (``v`` already reduced modulo the alphabet length)."""
    return f"substr('{alphabet}', {v} + 1, 1)"


def _outputs(d: _Dialect) -> list[tuple[str, str]]:
    cat = (lambda xs: "concat(" + ", ".join(xs) + ")") if d.spark else (lambda xs: "(" + " || ".join(xs) + ")")
    name_full = cat([_char(LETTERS, f"_n{i}") for i in range(NAME_LEN[1])])
    middle = cat([_char(ADDRESS_CHARS, f"_m{i}") for i in range(ADDRESS_LEN[1] - 2)])
    name_len = f"({NAME_LEN[0]} + _nlen)"
    addr_len = f"({ADDRESS_LEN[0]} + _alen)"
    first = _char(ALNUM, "_afirst")
    last = _char(ALNUM, "_alast")
    address = cat([first, f"substr({middle}, 1, {addr_len} - 2)", last])
    conts = ", ".join(f"'{c}'" for c in CONTINENTS)
    pick = "(_cont + 1)"
    continent = f"element_at(array({conts}), {pick})" if d.spark else f"([{conts}])[{pick}]"
    return [
        ("id", "CAST(_id - 2147483648 AS INTEGER)"),
        ("name", f"substr({name_full}, 1, {name_len})"),
        ("address", address),
        ("continent", continent),
    ]


def records_for_rows(df: DataFrame, row_col: str, seed: int = 42) -> DataFrame:
    """One synthetic record per row of ``df``, keyed by its BIGINT ``row_col`` value.

    A handful of narrow projections (one per hash round) that Catalyst keeps
    apart, so each intermediate value is computed once per row.
    """
    d = _Dialect(spark=True)
    out = df.select(F.col(row_col).cast("bigint").alias("_row"))
    for stage in _stages("_row", seed, d):
        out = out.selectExpr(*[f"{sql} AS {name}" for name, sql in stage],
                             *[c for c in out.columns if c not in {n for n, _ in stage} and c != "_row"])
    return out.selectExpr(*[f"{sql} AS {name}" for name, sql in _outputs(d)])


def generate_records(
    spark: SparkSession, n: int, seed: int = 42, num_partitions: int | None = None
) -> DataFrame:
    """``n`` synthetic records, rows ``0..n-1``."""
    rng = spark.range(0, n, numPartitions=num_partitions) if num_partitions else spark.range(0, n)
    return records_for_rows(rng, "id", seed)


def generator_query(row_expr: str, source: str, seed: int = 42) -> str:
    """DuckDB SQL producing ``id, name, address, continent`` for every row of ``source``."""
    d = _Dialect(spark=False)
    sql = f"SELECT CAST({row_expr} AS BIGINT) AS _row FROM {source}"
    cols = ["_row"]
    for stage in _stages("_row", seed, d):
        names = [n for n, _ in stage]
        carry = [c for c in cols if c not in names and c != "_row"]
        sql = f"SELECT {', '.join(f'{s} AS {n}' for n, s in stage + [(c, c) for c in carry])} FROM ({sql})"
        cols = names + carry
    outs = ", ".join(f"{s} AS {n}" for n, s in _outputs(d))
    return f"SELECT {outs} FROM ({sql})"
