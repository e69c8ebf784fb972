"""Orders a caller makes up: expressions with null placement, and one comparable text per row.

A sort key is a list of columns (:func:`sortproof.operators.sort.order_spec`).
:class:`By` adds parts that are any SQL expression over the row.  They are
computed as columns before a sort, a rank or an order check, so everything
that works on columns works on them.

:func:`sort_key` turns a whole key into one string whose plain comparison is
the key's order, whatever its types, directions and null placements.  Bounds
between ranges can so be kept as text and compared with any dataset's rows.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class By:
    """One part of an order: a deterministic SQL expression, its direction, and where its nulls go.

    Without ``nulls`` they go where Spark puts them: first when ascending,
    last when descending.
    """

    expression: str
    ascending: bool = True
    nulls: str | None = None

    def __post_init__(self) -> None:
        if self.nulls not in (None, "first", "last"):
            raise ValueError(f"nulls go 'first' or 'last', not {self.nulls!r}")
        if not self.expression.strip():
            raise ValueError("an order needs an expression")

    @property
    def nulls_last(self) -> bool:
        return self.nulls == "last" if self.nulls else not self.ascending

    @property
    def name(self) -> str:
        """A name for files; different expressions have different ones."""
        readable = re.sub(r"\W+", "_", self.expression).strip("_")[:40]
        return f"by_{readable}_{zlib.crc32(self.expression.encode()):08x}" + ("_nulls_last" if self.nulls_last else "_nulls_first")


def key_items(key) -> list:
    """The parts of a key given as one part or several."""
    if isinstance(key, tuple) and len(key) == 2 and isinstance(key[1], bool):
        return [key]
    return list(key) if isinstance(key, (list, tuple)) else [key]


def with_order_columns(df: DataFrame, key) -> tuple[DataFrame, object]:
    """(``df`` with the columns that the key's expressions need, the key over columns alone).

    An expression becomes two columns: whether it is null, in the direction
    that its null placement asks for, and its value.
    """
    items = key_items(key)
    if not any(isinstance(i, By) for i in items):
        return df, key
    plain, added = [], {}
    for n, item in enumerate(items):
        if not isinstance(item, By):
            plain.append(item)
            continue
        value, flag = f"_by{n}", f"_by{n}_null"
        added[flag] = (F.expr(item.expression).isNull() == F.lit(item.nulls_last)).cast("int")
        added[value] = F.expr(item.expression)
        plain += [(flag, True), (value, item.ascending)]
    return df.withColumns({c: e for c, e in added.items() if c not in df.columns}), plain


# -- one comparable text -------------------------------------------------------

_DIGITS = "0123456789ABCDEF"


def _as_long(c: Column, kind: T.DataType) -> Column | None:
    """The value as a long in the same order, for types that have one."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return c.cast("int").cast("long") if isinstance(kind, T.BooleanType) else c.cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (c * F.lit(10**kind.scale).cast("decimal(20,0)")).cast("long")
    return None


def _comparable(c: Column, kind: T.DataType, ascending: bool, java_string_order: bool) -> Column:
    """Digits of one value, without a digit after which another value's digits could go on."""
    number = _as_long(c, kind)
    if number is not None:
        body = F.lpad(F.hex(number.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
        return body if ascending else F.translate(body, _DIGITS, _DIGITS[::-1])
    if isinstance(kind, T.StringType):
        body = F.hex(F.encode(c, "UTF-16BE" if java_string_order else "UTF-8"))
    elif isinstance(kind, T.BinaryType):
        body = F.hex(c)
    else:
        raise ValueError(f"no comparable text for values of type {kind.simpleString()}")
    # an end mark below all digits, or above them where the order is turned round
    return F.concat(body, F.lit("!")) if ascending else F.concat(F.translate(body, _DIGITS, _DIGITS[::-1]), F.lit("~"))


def sort_key(df: DataFrame, spec: list[tuple[str, bool]], java_string_order: bool = False) -> Column:
    """One string per row of ``df`` that compares as the columns of ``spec`` do.

    Nulls come first where a column ascends and last where it descends, as in
    Spark's sorts.  Types: integers, booleans, dates, timestamps, decimals of
    up to 18 digits, strings, binaries.
    """
    parts = []
    for name, ascending in spec:
        c, kind = F.col(f"`{name}`"), df.schema[name].dataType
        value = F.concat(F.lit("1"), _comparable(c, kind, ascending, java_string_order))
        parts.append(F.coalesce(value, F.lit("0" if ascending else "2")))
    return F.concat(*parts)
