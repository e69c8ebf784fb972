"""Java ``String.hashCode`` as a Spark column.

``h(s) = sum(c[i] * 31^(n-1-i)) mod 2^32`` over the UTF-16 code units of
``s``, read as a signed 32-bit int.  Spark has no built-in for it; three
implementations are offered, all exact on the data they accept:

* ``"jvm"`` (default): ``java_method('java.util.Objects', 'hashCode', s)`` -
  Java's own method, called by Spark's reflection expression inside the JVM
  task; exact for all text, no Python worker.  Spark treats reflection as
  non-deterministic, so it may appear in projections and filters but not
  directly inside an aggregate's arguments: hash in a projection, then
  aggregate the column (as every caller here does).
* ``"arrow"``: an Arrow UDF that works on the raw string buffer of each
  batch with numpy; no Python object per row.  Exact for all text
  (non-ASCII batches are re-encoded to UTF-16).
* ``"sql"``: a pure SQL ``aggregate`` over the characters; interpreted per
  character and exact only for BMP text.

Measured on 2M generated records (local[8], warm): jvm 1.4 s, arrow 1.7 s
(plus Python worker start-up when cold), sql about 2x arrow.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sortproof._pickling import ship_by_value

ship_by_value(__name__)

_MASK32 = (1 << 32) - 1
_POW_CACHE = np.ones(1, dtype=np.uint32)


def _pow31(n: int) -> np.ndarray:
    """31**k mod 2**32 for k < n (uint32, wrapping)."""
    global _POW_CACHE
    if _POW_CACHE.size < n:
        size = max(n, 2 * _POW_CACHE.size, 64)
        out = np.empty(size, dtype=np.uint32)
        out[0] = 1
        k = 1
        while k < size:
            m = min(k, size - k)
            out[k : k + m] = out[:m] * np.uint32(pow(31, k, 1 << 32))
            k += m
        _POW_CACHE = out
    return _POW_CACHE


def java_hash_array(arr: pa.Array) -> np.ndarray:
    """Java hashCode of every string in ``arr`` (nulls hash to 0)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.type != pa.large_string():
        arr = arr.cast(pa.large_string())
    n = len(arr)
    out = np.zeros(n, dtype=np.uint32)
    if n == 0:
        return out.view(np.int32)
    _, off_buf, data_buf = arr.buffers()
    offs = np.frombuffer(off_buf, dtype=np.int64)[arr.offset : arr.offset + n + 1]
    lo, hi = int(offs[0]), int(offs[-1])
    data = (
        np.frombuffer(data_buf, dtype=np.uint8)[lo:hi]
        if data_buf is not None
        else np.zeros(0, dtype=np.uint8)
    )
    if data.size and int(data.max()) >= 128:
        # Non-ASCII in this batch: UTF-16 code units differ from bytes.
        units = [
            np.frombuffer(s.encode("utf-16-be"), dtype=">u2") if s else np.zeros(0, ">u2")
            for s in arr.to_pylist()
        ]
        lens = np.fromiter((u.size for u in units), dtype=np.int64, count=n)
        cu = np.concatenate(units).astype(np.uint32) if lens.sum() else np.zeros(0, np.uint32)
    else:
        lens = np.diff(offs)
        cu = data.astype(np.uint32)
    total = int(lens.sum())
    if total == 0:
        return out.view(np.int32)
    ends = np.cumsum(lens)
    owner = np.repeat(np.arange(n), lens)
    exp = ends[owner] - 1 - np.arange(total)
    prod = cu * _pow31(int(lens.max()))[exp]  # uint32 arithmetic wraps mod 2^32
    nz = lens > 0
    out[nz] = np.add.reduceat(prod, (ends - lens)[nz])
    return out.view(np.int32)


@F.arrow_udf(T.IntegerType())
def _java_hash_udf(s: pa.Array) -> pa.Array:
    return pa.array(java_hash_array(s), type=pa.int32())


def _java_hash_sql(c: Column) -> Column:
    unsigned = F.aggregate(
        F.split(c, "", -1),
        F.lit(0).cast("bigint"),
        lambda acc, ch: (acc * 31 + F.ascii(ch)).bitwiseAND(F.lit(_MASK32)),
    )
    # [0, 2^32) -> signed int32 without evaluating the aggregate twice
    return ((unsigned + F.lit(1 << 31)).bitwiseAND(F.lit(_MASK32)) - F.lit(1 << 31)).cast("int")


def java_string_hash(c: Column | str, impl: str = "jvm") -> Column:
    """Java ``String.hashCode`` of a string column as INT."""
    col = F.col(c) if isinstance(c, str) else c
    if impl == "jvm":
        return F.java_method(F.lit("java.util.Objects"), F.lit("hashCode"), col).cast("int")
    if impl == "arrow":
        return _java_hash_udf(col)
    if impl == "sql":
        return _java_hash_sql(col)
    raise ValueError(f"unknown impl {impl!r}; use 'jvm', 'arrow' or 'sql'")
