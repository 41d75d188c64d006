"""Field rules against the Python standard library."""

import hashlib
import re
from datetime import UTC, datetime
from decimal import ROUND_HALF_EVEN, Decimal, InvalidOperation

import json
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderloom.functions import hashing, json_values, money, text, timestamps

AMOUNTS = [
    "20.00", "20", " 10 ", "　10\t", "1e3", "1_000", "NaN", "Infinity", "-1", "-0", "-0.001",
    "-1e-30", "0.125", "0.135", "0.005", "0.015", "0.12500000004", "0.12500000000000000000000000001",
    "0.125000000000000000000000000000", "999999999999999.99", "999999999999999.999",
    "1000000000000000", "1e15", "1e-999999", "1e999999", "", ".5", "5.", "+5", "0x1", "1,5", "12 3",
    "0.1e1", "1.25e-1", "123456789012345.675", "0.0049999", "0.995", "_1_", "--1", "e1",
]
NUMBERS = [
    "20", "20.5", "1e3", "0.125", "0.135", "2.675", "1.005", "true", "null", "[1]", "{}",
    "123456789012345678", "999999999999999.99", "1e400", "0.12500000000000000001", "1e-5", "-1",
]
TIMES = [
    "2026-01-15T10:00:00Z", "2026-01-15T10:00:00+00:00", "20260115T100000Z", "2026-W03-4T10:00:00Z",
    "2026W034T10Z", "2026-W03T10Z", "2026-01-15", "2026-01-15T10:00:00", "2026-01-15T10",
    "2026-13-01T00:00:00Z", "2026-02-30T00:00:00Z", "2026-01-15T25:00:00Z", "0000-01-01T00:00:00Z",
    "2026-01-15T10:00:00.1234567+02:30", "2026-01-15T10:00:00,5-02:30", "2026-01-15 10:00:60Z",
    "2026-01-15T10:00:00+23:59", "2026-01-15T10:00:00+24:00", "2026-01-15T10:00:00z", "",
    "2026-01-15+00:00", "2026-W54-1T00:00:00Z", "2026-01-15T10:00:00+00:00:30", "Z",
    "2026-01-15T10:00:00+0030", "2026-01-15x10:00Z", "2026-01-15T1000Z", "2020-W53-7T00:00:00Z",
    "2021-W53-1T00:00Z", "2026-01-15T10:00:00.000000Z", "2026-01-15T10:00:00-00:00",
    "1969-12-31T23:59:59.999999Z", "9999-12-31T23:59:59Z",
]


def expected_amount(value):
    try:
        number = Decimal(value)
    except InvalidOperation:
        return None
    if not number.is_finite() or number < 0 or number >= 10**15:
        return None
    return abs(number.quantize(Decimal("0.01"), rounding=ROUND_HALF_EVEN))


def expected_time(value):
    try:
        moment = datetime.fromisoformat(value.replace("Z", "+00:00"))
    except ValueError:
        return None, False
    if moment.tzinfo is None:
        return None, True
    return moment.astimezone(UTC).isoformat().replace("+00:00", "Z"), False


def amounts(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    as_json = F.try_variant_get(F.try_parse_json(F.to_json(F.struct("v"))), "$.v", "variant")
    return frame.select("v", money.amount_text(F.col("v")), money.amount(as_json)).collect()


def test_amount_texts(spark):
    for value, plain, variant in amounts(spark, AMOUNTS):
        assert plain == variant == expected_amount(value), value


@settings(max_examples=5, deadline=None)
@given(st.lists(st.from_regex(r"[0-9]{1,14}\.[0-9]{0,25}(e-?[0-3])?", fullmatch=True), min_size=20))
def test_random_amount_texts(spark, values):
    for value, plain, variant in amounts(spark, values):
        assert plain == variant == expected_amount(value), value


def test_json_amounts(spark):
    frame = spark.createDataFrame([(v,) for v in NUMBERS], "v string")
    for value, got in frame.select("v", money.amount(F.try_parse_json("v"))).collect():
        parsed = json.loads(value)
        assert got == (None if parsed is None else expected_amount(str(parsed))), value


def test_timestamps(spark):
    frame = spark.createDataFrame([(v,) for v in TIMES], "v string")
    moment = timestamps.utc_timestamp(F.col("v"))
    rows = frame.select("v", timestamps.canonical_text(moment), timestamps.lacks_zone(F.col("v")))
    for value, utc, zoneless in rows.collect():
        assert (utc, zoneless) == expected_time(value), value


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    frame = spark.createDataFrame([("2026-03-29T02:30:00Z",)], "v string")
    text_now = timestamps.canonical_text(timestamps.utc_timestamp(F.col("v")))
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert frame.select(text_now).first()[0] == "2026-03-29T02:30:00Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_every_blank_is_trimmed(spark):
    blanks = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
    assert set(text.BLANKS) == set(blanks)
    frame = spark.createDataFrame([(f"{blanks}a b{blanks}",)], "v string")
    assert frame.select(text.trim_blanks(F.col("v"))).first()[0] == "a b"
    assert frame.select(text.trim_blanks_right(F.col("v"))).first()[0] == f"{blanks}a b"


def test_emptiness_of_json_values(spark):
    values = ["null", "false", "0", "0.0", "-0", "0e5", '""', "[]", "{}", "1", '"0"', "[0]", "true"]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    for value, empty in frame.select("v", json_values.is_empty(F.try_parse_json("v"))).collect():
        assert empty == (not json.loads(value)), value


def test_identifiers(spark):
    values = {"a": True, "A-1_b": True, "-a": False, "": False, "a" * 80: True, "a" * 81: False, "a\n": False}
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    for value, valid in frame.select("v", text.is_identifier(F.col("v"))).collect():
        assert valid == values[value]


def brute_fingerprint(texts):
    combined = 0
    for text_of_row in texts:
        combined ^= int(hashlib.sha256(text_of_row.encode()).hexdigest(), 16)
    digits = f"{combined:064x}"
    return ":".join([str(len(texts)), *[str(int(digits[i : i + 15], 16)) for i in (0, 15, 30, 45)]])


def test_fingerprints_read_no_row_as_a_number(spark):
    rows = spark.range(40).selectExpr("id % 9 as g", "if(id % 7 = 0, null, concat('row ', id)) as row")
    found = rows.groupBy("g").agg(hashing.fingerprint(F.col("row")).alias("f"))
    for group, value in found.collect():
        assert value == brute_fingerprint([f"row {i}" for i in range(40) if i % 9 == group and i % 7])
    empty = rows.filter("g < 0").agg(hashing.fingerprint(F.col("row"))).first()[0]
    assert empty == "0:0:0:0:0"
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"bit_xor\(crc32", plan) and not re.search(r"bit_xor\(cast\(conv", plan)


def test_rows_are_told_apart_without_escaping_them(spark):
    rows = [("a", "b"), ("a1:b", ""), ("", "a1:b"), (None, "-"), ("-", None), ("", None), (None, None), ("é", '"'), ("\"", "é")]
    frame = spark.createDataFrame(rows, "x string, y string")
    assert frame.select(hashing.whole_row(frame)).distinct().count() == len(rows)
    plan = frame.select(hashing.whole_row(frame))._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json" not in plan
