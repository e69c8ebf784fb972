"""Whole-table parse and validation jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import Column

from sortproof.functions.record import (
    csv_fields,
    null_field_reason,
    parse_id,
    reject_reason_of,
    strict_guard,
    to_csv_checked,
)
from sortproof.schema import RECORD_COLUMNS
from sortproof.session import write_and_read


def _split(lines: DataFrame, value_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    # The split is its own projection so that it is computed once per line
    # (Catalyst does not inline a non-trivial expression used many times).
    return lines.select(*keep, F.col(value_col).alias("_v"), csv_fields(value_col).alias("_p"))


def _fields(parts: Column) -> list[Column]:
    return [
        parse_id(F.get(parts, 0)).alias("id"),
        F.get(parts, 1).alias("name"),
        F.get(parts, 2).alias("address"),
        F.get(parts, 3).alias("continent"),
    ]


def parse_strict(lines: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """CSV lines -> records; the job fails on the first bad line.

    The guard is folded into the ``id`` column so that column pruning can
    never drop it (an action that needs no record column at all, such as a
    bare count, parses nothing).  ``keep`` carries other input columns along,
    e.g. the partition and offset of a log.
    """
    s = _split(lines, value_col, keep)
    v, p = F.col("_v"), F.col("_p")
    cols = _fields(p)
    guarded_id = F.coalesce(strict_guard(reject_reason_of(v, p), v).cast("int"), cols[0]).alias("id")
    return s.select(*keep, guarded_id, *cols[1:])


def tag_lines(lines: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Every line with its parsed fields and ``reason`` (NULL = good).

    ``keep`` carries other input columns along (e.g. topic, partition,
    offset of a log); works on batch and streaming DataFrames.
    """
    s = _split(lines, value_col, keep)
    v, p = F.col("_v"), F.col("_p")
    return s.select(*keep, v.alias("value"), reject_reason_of(v, p).alias("reason"), *_fields(p))


def parse_quarantine(lines: DataFrame, path: str | None = None,
                     value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """CSV lines -> (records, rejects).

    With ``path`` the input is read once: one write with a ``status``
    partition column, and the two outputs are partition-pruned reads of it.
    Without ``path`` both outputs are lazy filters of the same plan.
    """
    tagged = tag_lines(lines, value_col)
    if path:
        tagged = tagged.withColumn("status", F.when(F.col("reason").isNull(), "ok").otherwise("rejected"))
        tagged = write_and_read(tagged, path, partition_by=["status"])
        good = tagged.filter(F.col("status") == "ok")
        bad = tagged.filter(F.col("status") == "rejected")
    else:
        good = tagged.filter(F.col("reason").isNull())
        bad = tagged.filter(F.col("reason").isNotNull())
    return good.select(*RECORD_COLUMNS), bad.select("value", "reason")


def tag_records(df: DataFrame) -> DataFrame:
    """Typed records with ``reason`` (``NULL_FIELD`` or NULL) and ``value``, one pass.

    ``value`` is the CSV line of a good record and a best-effort line (nulls
    as empty fields) of a rejected one.
    """
    reason = F.when(F.col("id").isNull(), F.lit("NULL_FIELD")).otherwise(null_field_reason())
    t = df.withColumn("reason", reason)
    loose = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RECORD_COLUMNS])
    return t.withColumn("value", F.when(F.col("reason").isNull(), to_csv_checked()).otherwise(loose))


def validate_records(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed records -> (valid, rejects with ``NULL_FIELD``).

    Two lazy filters of :func:`tag_records`; use that directly (or persist
    it) when both outputs are consumed, so the input is read once.
    """
    tagged = tag_records(df)
    good = tagged.filter(F.col("reason").isNull()).select(*RECORD_COLUMNS)
    bad = tagged.filter(F.col("reason").isNotNull()).select("value", "reason")
    return good, bad


def encode_records(df: DataFrame) -> DataFrame:
    """Records -> CSV lines (P1) as a ``value`` column."""
    return df.select(to_csv_checked().alias("value"))
