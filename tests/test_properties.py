"""Property tests: hashing and CSV round trip on random input."""

import random

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from sortproof.functions.hashing import java_hash_array, java_string_hash
from sortproof.operators.parse import encode_records, parse_strict
from sortproof.schema import RECORD_SCHEMA


def java_hash_reference(s: str) -> int:
    """Java String.hashCode by its definition (UTF-16 code units, int32 wrap)."""
    units = s.encode("utf-16-be")
    h = 0
    for i in range(0, len(units), 2):
        h = (31 * h + int.from_bytes(units[i : i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=30))
def test_java_hash_matches_definition(strings):
    got = list(java_hash_array(pa.array(strings, type=pa.string())))
    assert got == [java_hash_reference(s) for s in strings]


def _bmp_text(rng, n):
    alphabet = [chr(c) for c in list(range(32, 127)) + list(range(0xA0, 0x3000, 37)) + [0xFFEE, 0xFFFF - 2]]
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_sql_and_arrow_hash_agree_on_bmp_text(spark):
    rng = random.Random(11)
    strings = [_bmp_text(rng, rng.randrange(0, 30)) for _ in range(2_000)]
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    bad = df.filter(java_string_hash("s", "arrow") != java_string_hash("s", "sql")).count()
    assert bad == 0
    sample = {r.s: r.h for r in df.select("s", java_string_hash("s").alias("h")).limit(50).collect()}
    assert all(h == java_hash_reference(s) for s, h in sample.items())


def test_csv_round_trip_random_records(spark):
    rng = random.Random(5)

    def field():
        return "".join(rng.choice("abcXYZ 09é日\t;\"'") for _ in range(rng.randrange(0, 12)))

    rows = [(rng.randint(-(2**31), 2**31 - 1), field(), field(), field()) for _ in range(3_000)]
    df = spark.createDataFrame(rows, RECORD_SCHEMA)
    back = parse_strict(encode_records(df))
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
