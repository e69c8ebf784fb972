"""Schemas and the named sort keys."""

from __future__ import annotations

from pyspark.sql import types as T

# One record: the reference's 4-field row.  No field may be null.
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("address", T.StringType(), False),
        T.StructField("continent", T.StringType(), False),
    ]
)
RECORD_COLUMNS = [f.name for f in RECORD_SCHEMA.fields]

# Table stand-in for a message-log topic: the columns of Spark's Kafka
# source, with strings instead of binary for key and value.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType(), True),
        T.StructField("value", T.StringType(), True),
        T.StructField("topic", T.StringType(), False),
        T.StructField("partition", T.IntegerType(), False),
        T.StructField("offset", T.LongType(), False),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)

# One row per verification finding.
REPORT_SCHEMA = T.StructType(
    [
        T.StructField("check", T.StringType(), False),
        T.StructField("dataset", T.StringType(), False),
        T.StructField("value", T.StringType(), True),
        T.StructField("passed", T.BooleanType(), False),
    ]
)

# Position columns written next to every sorted output: the range a row
# fell into (range order = key order) and its 0-based place inside it.
RANGE_COL = "range_id"
OFFSET_COL = "offset"

# Number of a sorted chunk among those of its input partition.
RUN_COL = "run"

# Named sort keys (case-insensitive).  The value is the primary key column;
# the remaining record columns are appended as tie-breakers so that the
# output (and every rank) is reproducible.
SORT_KEYS = {"ID": "id", "NAME": "name", "CONTINENT": "continent"}
