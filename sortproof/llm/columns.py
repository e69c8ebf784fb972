"""Column helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space of the contracts, U+0020 and U+0009 to U+000D.
SPACES = " \t\n\x0b\f\r"
SPACE_PATTERN = "[\\x20\\x09-\\x0D]+"

#: Stands for a null document id inside an operator; text hashes beside it keep such rows apart.
NO_ID = -1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A lambda's variable is bound to a computed value.  Without this, the
    optimizer may copy a costly expression into the lambda of a higher-order
    function, where it would run once per array element.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of a text: maximal runs of characters other than white space (null or blank: none)."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_PATTERN, -1)).otherwise(
        F.array().cast("array<string>")
    )


def word_count(text: Column) -> Column:
    """Number of words of a text as long (null: 0)."""
    return F.size(words(text)).cast("long")


def utf8_bytes(text: Column) -> Column:
    """Bytes of a text in UTF-8 (null: 0)."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def row_identity(doc_id: str, text: str) -> list[Column]:
    """Two columns, ``_id`` and ``_t``, that tell documents apart.

    Rows with the same id and the same text are one document; rows without an
    id are told apart by their texts.
    """
    return [
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID).cast("long")).alias("_id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_t"),
    ]


def columns_of(df: DataFrame, *names: str) -> list[Column]:
    """The named columns, quoted, so that dots and odd characters in other columns do no harm."""
    return [F.col(f"`{n}`") for n in names]
