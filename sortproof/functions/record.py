"""Column builders for one record: encode, parse, validate, size, hash.

All of these are plain column expressions; the whole-table jobs that use
them live in :mod:`sortproof.operators`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sortproof.functions.hashing import java_string_hash


# Fixed value: the ASCII characters that Java counts as white space.
JAVA_SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f "


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- P1, P8
def to_csv(
    id: Column | str = "id",
    name: Column | str = "name",
    address: Column | str = "address",
    continent: Column | str = "continent",
) -> Column:
    """Record -> CSV line ``id,name,address,continent``.

    ``concat`` and not ``concat_ws``: a null field must give a null line,
    not a silently shorter one.
    """
    return F.concat(
        _c(id).cast("string"), F.lit(","), _c(name), F.lit(","), _c(address), F.lit(","), _c(continent)
    )


def message_key(id: Column | str = "id") -> Column:
    """Message key of a record: the decimal id."""
    return _c(id).cast("string")


def has_separator(*cols: Column | str) -> Column:
    """True when any field holds a comma or a line break (cannot be encoded)."""
    cond = F.lit(False)
    for c in cols:
        col = _c(c)
        cond = cond | col.contains(",") | col.contains("\n") | col.contains("\r")
    return cond


def to_csv_checked(
    id: Column | str = "id",
    name: Column | str = "name",
    address: Column | str = "address",
    continent: Column | str = "continent",
) -> Column:
    """:func:`to_csv` that fails the job on a record it cannot encode.

    The format has no quoting: a comma or line break inside a field, or a
    null field, would produce a line that does not parse back.
    """
    bad_null = _c(id).isNull() | _c(name).isNull() | _c(address).isNull() | _c(continent).isNull()
    return F.when(
        bad_null | has_separator(name, address, continent),
        F.raise_error(F.concat(F.lit("Record cannot be encoded as CSV (null field, comma or line break): "),
                               F.coalesce(_c(id).cast("string"), F.lit("<null id>")))),
    ).otherwise(to_csv(id, name, address, continent))


# ---------------------------------------------------------------- P2-P4
def csv_fields(value: Column | str = "value") -> Column:
    """The comma-separated fields of a line, trailing empties kept."""
    return F.split(_c(value), ",", -1)


def parse_id(field: Column) -> Column:
    """Whitespace-stripped decimal int32, or NULL when it is not one.

    White space is Java's (``strip()``) in ASCII; the rest must be
    ``[+-]?[0-9]+`` within the int32 range.  Spark's own cast would also drop
    control characters around the number, so the text is tested first.
    """
    text = F.btrim(field, F.lit(JAVA_SPACES))
    return F.when(text.rlike(r"^[+-]?[0-9]+\z"), text.try_cast("int"))


def reject_reason_of(value: Column, parts: Column) -> Column:
    """Why a line cannot become a record (P3), from it and its split fields; NULL for a good line.

    ``BLANK``: null or only whitespace; ``FIELD_COUNT``: not exactly four
    fields; ``BAD_ID``: first field is not a 32-bit decimal integer.  A blank line has no comma, so it always fails the field count; the
    whitespace regex therefore runs only for lines that are bad anyway.
    """
    return (
        F.when(value.isNull(), F.lit("BLANK"))
        .when(F.size(parts) != 4, F.when(value.rlike(r"^\s*$"), F.lit("BLANK")).otherwise(F.lit("FIELD_COUNT")))
        .when(parse_id(F.get(parts, 0)).isNull(), F.lit("BAD_ID"))
    )


def null_field_reason(name: Column | str = "name", address: Column | str = "address",
                      continent: Column | str = "continent") -> Column:
    """``NULL_FIELD`` when a string field of a record is null."""
    return F.when(
        _c(name).isNull() | _c(address).isNull() | _c(continent).isNull(), F.lit("NULL_FIELD")
    )


def strict_guard(reason: Column, value: Column | str = "value") -> Column:
    """Raise (fail the job) on a bad line, as the reference does."""
    return F.when(
        reason.isNotNull(),
        F.raise_error(F.concat(F.lit("Bad record line ("), reason, F.lit("): "),
                               F.substring(F.coalesce(_c(value), F.lit("<null>")), 1, 80))),
    )


# ---------------------------------------------------------------- P5
def size_estimate(
    name: Column | str = "name",
    address: Column | str = "address",
    continent: Column | str = "continent",
    utf16_exact: bool = False,
) -> Column:
    """Estimated in-memory bytes of a record: 44 + 2 per UTF-16 unit (P5).

    ``length`` counts code points; ``utf16_exact`` counts UTF-16 units,
    which differs only for characters outside the BMP.
    """
    if utf16_exact:
        units = lambda c: F.octet_length(F.encode(_c(c), "UTF-16BE"))  # noqa: E731  2 bytes/unit
        return (F.lit(44) + units(name) + units(address) + units(continent)).cast("bigint")
    return (F.lit(44) + 2 * (F.length(_c(name)) + F.length(_c(address)) + F.length(_c(continent)))).cast(
        "bigint"
    )


# ---------------------------------------------------------------- P6, P7
def row_hash(
    id: Column | str = "id",
    name: Column | str = "name",
    address: Column | str = "address",
    continent: Column | str = "continent",
    impl: str = "jvm",
) -> Column:
    """``((id*31 + h(name))*31 + h(address))*31 + h(continent)`` as BIGINT.

    Every term is an int32, so the value stays below 2^46 in magnitude and
    plain BIGINT arithmetic never overflows.
    """
    h = lambda c: java_string_hash(c, impl).cast("bigint")
    return ((_c(id).cast("bigint") * 31 + h(name)) * 31 + h(address)) * 31 + h(continent)


# ---------------------------------------------------------------- A2 helpers
_TWO64 = "18446744073709551616"
_TWO63 = "9223372036854775808"


def wrap_int64(dec: Column) -> Column:
    """A DECIMAL(38,0) value reduced to a wrapping signed 64-bit BIGINT."""
    two64 = F.lit(_TWO64).cast("decimal(38,0)")
    two63 = F.lit(_TWO63).cast("decimal(38,0)")
    return (F.pmod(dec + two63, two64) - two63).cast("bigint")


def wide_sum(c: Column | str) -> Column:
    """Exact sum of a BIGINT as DECIMAL(38,0), 0 without rows.

    Summed in three pieces of 21, 21 and 22 bits (the last with the sign), as
    longs: exact up to 2^41 rows, and no decimal is made per row.
    """
    x, low = _c(c), F.lit((1 << 21) - 1)
    pieces = [x.bitwiseAND(low), F.shiftright(x, 21).bitwiseAND(low), F.shiftright(x, 42)]
    wide = [F.coalesce(F.sum(p), F.lit(0)).cast("decimal(38,0)") for p in pieces]
    return wide[0] + wide[1] * F.lit(1 << 21).cast("decimal(38,0)") + wide[2] * F.lit(1 << 42).cast("decimal(38,0)")


def wrapping_sum(c: Column | str) -> Column:
    """Sum with Java ``long`` wrap-around; ANSI ``sum(bigint)`` would raise."""
    return wrap_int64(wide_sum(c))
