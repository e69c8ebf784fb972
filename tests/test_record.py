"""Record encode/parse/validate/hash/size (mirrors the reference's record tests)."""

import pytest

from sortproof.functions.hashing import java_hash_array, java_string_hash
from sortproof.functions.record import row_hash, size_estimate, to_csv
from sortproof.operators.parse import (
    encode_records,
    parse_quarantine,
    parse_strict,
    tag_lines,
    validate_records,
)


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_round_trip_typical(spark, records_df):
    df = records_df([(42, "Alice", "123 Main St", "Europe"), (99, "Bob", "456 Oak Ave", "Asia")])
    enc = encode_records(df)
    assert sorted(r.value for r in enc.collect()) == ["42,Alice,123 Main St,Europe", "99,Bob,456 Oak Ave,Asia"]
    back = parse_strict(enc).collect()
    assert sorted(tuple(r) for r in back) == sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("rid", [-7, -2147483648, 2147483647, 0])
def test_extreme_ids_round_trip(spark, records_df, rid):
    df = records_df([(rid, "n", "a", "c")])
    assert parse_strict(encode_records(df)).first()["id"] == rid


def test_empty_fields_are_valid(spark):
    r = parse_strict(lines(spark, ["1,,,"])).first()
    assert tuple(r) == (1, "", "", "")


@pytest.mark.parametrize(
    "value,reason",
    [
        (None, "BLANK"),
        ("   ", "BLANK"),
        ("", "BLANK"),
        ("1,Alice,somewhere", "FIELD_COUNT"),
        ("1,Alice,somewhere,Europe,extra", "FIELD_COUNT"),
        ("abc,Alice,somewhere,Europe", "BAD_ID"),
        (",Alice,somewhere,Europe", "BAD_ID"),
        ("1.5,Alice,somewhere,Europe", "BAD_ID"),
        ("2147483648,Alice,somewhere,Europe", "BAD_ID"),
        (" 12 ,Alice,somewhere,Europe", None),
        ("+12,Alice,somewhere,Europe", None),
    ],
)
def test_reject_reasons(spark, value, reason):
    got = tag_lines(lines(spark, [value])).first()["reason"]
    assert got == reason


def test_strict_parse_fails_job(spark):
    with pytest.raises(Exception, match="FIELD_COUNT"):
        parse_strict(lines(spark, ["1,a,b,c", "1,Alice,somewhere"])).collect()


def test_quarantine_one_pass(spark, tmp_path):
    good, bad = parse_quarantine(
        lines(spark, ["1,a,b,c", "x,a,b,c", "   ", "2,a,b"]), path=str(tmp_path / "q"))
    assert good.count() == 1
    assert sorted(r.reason for r in bad.collect()) == ["BAD_ID", "BLANK", "FIELD_COUNT"]


def test_null_fields_rejected(spark):
    df = spark.createDataFrame([(1, None, "a", "c"), (2, "n", None, "c"), (3, "n", "a", None), (4, "n", "a", "c")],
                               "id int, name string, address string, continent string")
    good, bad = validate_records(df)
    assert good.count() == 1
    assert {r.reason for r in bad.collect()} == {"NULL_FIELD"}


# Java String.hashCode values (fixed, from the Java definition)
JAVA_HASHES = [("Alice", 63350368), ("", 0), ("héllo", 103094734), ("日本", 835047),
               ("\U0001F600x", 54959989), ("￮", 65518)]


@pytest.mark.parametrize("impl", ["jvm", "arrow", "sql"])
def test_java_string_hash(spark, impl):
    df = spark.createDataFrame([(s,) for s, _ in JAVA_HASHES], "s string")
    got = dict((r.s, r.h) for r in df.select("s", java_string_hash("s", impl).alias("h")).collect())
    for s, h in JAVA_HASHES:
        if impl == "sql" and any(ord(ch) > 0xFFFF for ch in s):
            continue  # the SQL form is exact only for BMP text
        assert got[s] == h, s


def test_java_hash_array_direct():
    import pyarrow as pa

    arr = pa.array([s for s, _ in JAVA_HASHES])
    assert list(java_hash_array(arr)) == [h for _, h in JAVA_HASHES]


def test_row_hash_deterministic_and_distinct(spark, records_df):
    df = records_df([(1, "Alice", "addr1", "Europe"), (2, "Bob", "addr2", "Asia"), (1, "Alice", "addr1", "Europe")])
    hs = [r.h for r in df.select(row_hash().alias("h")).collect()]
    assert hs[0] == hs[2] and hs[0] != hs[1]
    # survives a CSV round trip
    back = parse_strict(encode_records(df)).select(row_hash().alias("h"))
    assert sorted(r.h for r in back.collect()) == sorted(hs)


def test_row_hash_formula(spark, records_df):
    df = records_df([(7, "Alice", "", "Asia")])
    h = df.select(row_hash().alias("h")).first().h
    jn, ja, jc = 63350368, 0, java_hash_array(__import__("pyarrow").array(["Asia"]))[0]
    assert h == ((7 * 31 + jn) * 31 + ja) * 31 + int(jc)


def test_size_estimate(spark, records_df):
    df = records_df([(1, "A", "B", "Asia"), (1, "AliceBobCharlie", "123 Main Street Apt 42", "North America")])
    small, big = [r.s for r in df.select(size_estimate().alias("s")).collect()]
    assert small == 44 + 2 * (1 + 1 + 4)
    assert 0 < small < big


def test_to_csv_null_gives_null(spark):
    df = spark.createDataFrame([(1, None, "a", "c")], "id int, name string, address string, continent string")
    assert df.select(to_csv().alias("v")).first().v is None


def test_size_estimate_utf16(spark):
    df = spark.createDataFrame([("\U0001F600", "", "")], "name string, address string, continent string")
    r = df.select(size_estimate().alias("a"), size_estimate(utf16_exact=True).alias("b")).first()
    assert (r.a, r.b) == (46, 48)


@pytest.mark.parametrize("bad", [(1, "a,b", "x", "y"), (1, "a", "x\ny", "y"), (1, None, "x", "y")])
def test_encoding_rejects_unencodable_records(spark, bad):
    df = spark.createDataFrame([bad], "id int, name string, address string, continent string")
    with pytest.raises(Exception, match="cannot be encoded"):
        encode_records(df).collect()


def test_text_lines_skip_empty_lines(spark, tmp_path):
    from sortproof.sources.log import read_lines

    p = tmp_path / "run.txt"
    p.write_text("1,a,b,c\n\n2,d,e,f\n\n")
    rows = parse_strict(read_lines(spark, str(p))).collect()
    assert sorted(r.id for r in rows) == [1, 2]


def test_ids_with_control_characters(spark):
    from sortproof.operators.parse import tag_lines

    good = ["5", " 5", "\t+5\x1f", "-5 ", "\x1c5\x1d"]
    bad = ["\x015", "5\x00", "\x7f5", "5\x08", "+ 5", "5 ", "++5", "5\n6"]
    rows = [(f"{x},n,a,c",) for x in good + bad]
    got = {r.value: r.reason for r in tag_lines(spark.createDataFrame(rows, "value string")).collect()}
    assert all(got[f"{x},n,a,c"] is None for x in good)
    assert all(got[f"{x},n,a,c"] == "BAD_ID" for x in bad)


def test_quarantine_of_nothing(spark, tmp_path):
    from sortproof.operators.parse import parse_quarantine

    good, rejects = parse_quarantine(spark.createDataFrame([], "value string"), str(tmp_path / "q"))
    assert good.count() == rejects.count() == 0


def test_checksums_are_summed_as_longs(spark):
    from sortproof.functions.record import wide_sum, wrapping_sum
    from sortproof.operators.aggregate import count_and_checksum

    top, low = (1 << 63) - 1, -(1 << 63)
    for values in ([top] * 5 + [low] * 2 + [-1, 0, None, 1 << 42, -(1 << 21) - 1], [low] * 7, [None], []):
        df = spark.createDataFrame([(v,) for v in values], "h long")
        total = sum(v or 0 for v in values)
        got = df.agg(wide_sum("h").alias("s"), wrapping_sum("h").alias("w")).first()
        assert int(got.s) == total and got.w == (total + (1 << 63)) % (1 << 64) - (1 << 63)
    df = spark.createDataFrame([(1, "a", "b", "c")], "id int, name string, address string, continent string")
    plan = count_and_checksum(df)._jdf.queryExecution().executedPlan().toString()
    assert "sum(cast(_h" not in plan and "partial_sum" in plan
