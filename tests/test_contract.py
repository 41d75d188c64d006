"""The contract's first error and canonical values, row by row."""

import copy
import json
from datetime import datetime
from decimal import Decimal

import pytest
from conftest import DROP, ORDER, money
from pyspark.sql import functions as F

from orderloom.catalog import contract as queries
from orderloom.functions import json_values
from orderloom.operators import contract

LINE = {
    "id": "line-2",
    "productName": "Mug",
    "productSku": None,
    "quantity": 1,
    "unitPrice": money("1"),
    "totalPrice": money("1"),
}

# (name, changes or raw text, first error or None for a valid order)
CASES = [
    ("valid", {}, None),
    ("not json", "not-json", "record must be valid JSON"),
    ("text after json", '{"a":1} x', "record must be valid JSON"),
    ("two values", '{"a":1},{"b":2}', "record must be valid JSON"),
    ("closes the wrapper", '{"a":1}],[{"b":2}', "record must be valid JSON"),
    ("list", "[1]", "record must be a JSON object"),
    ("number", "12", "record must be a JSON object"),
    ("null", "null", "record must be a JSON object"),
    ("empty object", "{}", "channel.currencyCode is required"),
    ("channel text", {"channel": "web"}, "channel must be an object"),
    ("channel list", {"channel": [1]}, "channel must be an object"),
    ("channel false", {"channel": False}, "channel.currencyCode is required"),
    ("channel zero", {"channel": 0}, "channel.currencyCode is required"),
    ("channel empty list", {"channel": []}, "channel.currencyCode is required"),
    ("channel missing", {"channel": DROP}, "channel.currencyCode is required"),
    ("code null", {"channel__currencyCode": None}, "channel.currencyCode is required"),
    ("code empty", {"channel__currencyCode": ""}, "channel.currencyCode is required"),
    (
        "code number",
        {"channel__currencyCode": 123},
        "channel.currencyCode must be a three-letter currency",
    ),
    (
        "code blank",
        {"channel__currencyCode": " USD"},
        "channel.currencyCode must be a three-letter currency",
    ),
    ("code foreign", {"channel__currencyCode": "GBP"}, "currency must be USD, EUR or PLN"),
    ("code letters", {"channel__currencyCode": "äöü"}, "currency must be USD, EUR or PLN"),
    ("code lower case", {"channel__currencyCode": "eur"}, None),
    ("lines missing", {"lines": DROP}, "lines must contain at least one line"),
    ("lines empty", {"lines": []}, "lines must contain at least one line"),
    ("lines text", {"lines": "x"}, "lines must contain at least one line"),
    ("connection empty", {"lines": {"edges": []}}, "lines must contain at least one line"),
    ("edges text", {"lines": {"edges": "x"}}, "line connection must contain a list"),
    ("nodes object", {"lines": {"nodes": {"a": 1}}}, "line connection must contain a list"),
    ("edge number", {"lines": {"edges": [5]}}, "line must be an object"),
    ("edge node null", {"lines": {"edges": [{"node": None}]}}, "lines[0] must be an object"),
    ("edges", {"lines": {"edges": [{"node": LINE}]}}, None),
    ("edges without node", {"lines": {"edges": [LINE]}}, None),
    ("nodes", {"lines": {"nodes": [LINE]}}, None),
    ("nodes with node", {"lines": {"nodes": [{"node": LINE}]}}, None),
    ("edges before nodes", {"lines": {"edges": [{"node": 1}], "nodes": [LINE]}}, "lines[0] must be an object"),
    ("list is not unwrapped", {"lines": [{"node": LINE}]}, "lines[0].id must be a nonempty string"),
    ("line number", {"lines__0": 7}, "lines[0] must be an object"),
    ("line id blank", {"lines__0__id": " 　"}, "lines[0].id must be a nonempty string"),
    ("line id number", {"lines__0__id": 7}, "lines[0].id must be a nonempty string"),
    ("line id twice", {"lines": [LINE, {**LINE, "id": " line-2 "}]}, "line IDs must be unique strings"),
    (
        "earlier line first",
        {"lines": [LINE, {**LINE, "id": "x", "quantity": 0}, LINE]},
        "lines[1].quantity must be a positive integer",
    ),
    *[
        (f"quantity {q!r}", {"lines__0__quantity": q}, "lines[0].quantity must be a positive integer")
        for q in (True, 0, -1, 2.0, "2", None, 2147483648, 10**30)
    ],
    ("name null", {"lines__0__productName": None}, "lines[0].productName must be a nonempty string"),
    ("sku blank", {"lines__0__productSku": " "}, "sku must be a nonempty string"),
    ("sku number", {"lines__0__productSku": 5}, "sku must be a nonempty string"),
    ("sku null", {"lines__0__productSku": None, "lines__0__variantSku": 5}, None),
    ("price null", {"lines__0__unitPrice": None}, "unitPrice must be an object"),
    ("gross null", {"lines__0__unitPrice": {}}, "lines[0].unitPrice.gross must be a money object"),
    ("gross text", {"lines__0__totalPrice__gross": "x"}, "lines[0].totalPrice.gross must be a money object"),
    ("total price list", {"lines__0__totalPrice": [1]}, "totalPrice must be an object"),
    (
        "price currency",
        {"lines__0__totalPrice__gross__currency": "eur"},
        "lines[0].totalPrice.gross currency must match order currency",
    ),
    *[
        (f"amount {a!r}", {"total__gross__amount": a}, "total.gross.amount must be numeric")
        for a in (None, "", "NaN", "Infinity", "-1", -0.01, True, "1,5", [1], {}, "1e15", 10**15)
    ],
    ("created missing", {"created": DROP}, "created must be an ISO-8601 timestamp"),
    ("created number", {"created": 5}, "created must be an ISO-8601 timestamp"),
    ("created bad", {"created": "2026-13-01T00:00:00Z"}, "created must be an ISO-8601 timestamp"),
    ("created date", {"created": "2026-01-15"}, "created must include a timezone"),
    ("updated zoneless", {"updatedAt": "2026-01-15T10:30:00"}, "updatedAt must include a timezone"),
    ("updated early", {"updatedAt": "2020-01-01T00:00:00Z"}, "updatedAt must not precede created"),
    ("updated other zone", {"updatedAt": "2026-01-15T11:00:00+01:00"}, None),
    ("status null", {"status": None}, "status must be a nonempty string"),
    ("status case", {"status": "draft"}, "unsupported order status"),
    ("status trimmed", {"status": " DRAFT "}, None),
    ("id number", {"id": 12}, "id must be a nonempty string"),
    ("number missing", {"number": DROP}, "number must be a nonempty string"),
    ("slug blank", {"channel__slug": "\t"}, "channel.slug must be a nonempty string"),
    ("total text", {"total": "20"}, "total must be an object"),
    ("total gross", {"total__gross": None}, "total.gross must be a money object"),
    ("total currency", {"total__gross__currency": "PLN"}, "total.gross currency must match order currency"),
    ("first of many", {"id": 1, "status": "x", "created": "x"}, "created must be an ISO-8601 timestamp"),
    ("unknown field", {"extra": {"deep": [1]}}, None),
    # Number literals that are valid in a field nobody reads, and wrong where a value is read.
    ("ignored nan", {"extra": float("nan")}, None),
    ("ignored infinities", {"extra": [float("inf"), {"x": -float("inf")}]}, None),
    ("ignored long number", {"extra": 10**1100}, None),
    ("ignored longest number", {"extra": -(10**4299)}, None),
    ("ignored long fraction", json.dumps(ORDER)[:-1] + ',"extra":1.' + "25" * 900 + "}", None),
    ("nan inside texts", {"number": 'NaN "\\" Infinity\\', "extra": float("nan")}, None),
    ("too many digits", json.dumps(ORDER)[:-1] + ',"extra":' + "9" * 4301 + "}", "record must be valid JSON"),
    ("no literal", json.dumps(ORDER)[:-1] + ',"extra":-NaN}', "record must be valid JSON"),
    ("total nan", {"total__gross__amount": float("nan")}, "total.gross.amount must be numeric"),
    ("total long", {"total__gross__amount": 10**1100}, "total.gross.amount must be numeric"),
    ("quantity infinity", {"lines__0__quantity": float("inf")}, "lines[0].quantity must be a positive integer"),
    ("sku nan", {"lines__0__productSku": float("nan")}, "sku must be a nonempty string"),
    ("channel nan", {"channel": float("nan")}, "channel must be an object"),
    ("code nan", {"channel__currencyCode": float("nan")}, "channel.currencyCode must be a three-letter currency"),
    ("lines nan", {"lines": float("nan")}, "lines must contain at least one line"),
]


@pytest.fixture(scope="module")
def judged(spark):
    def raw(change):
        if isinstance(change, str):
            return change
        order = copy.deepcopy(ORDER)
        for path, value in change.items():
            target, keys = order, [int(k) if k.isdigit() else k for k in path.split("__")]
            for key in keys[:-1]:
                target = target[key]
            if value is DROP:
                del target[keys[-1]]
            else:
                target[keys[-1]] = value
        return json.dumps(order)

    rows = [(name, raw(change)) for name, change, _ in CASES]
    frame = contract.judge(spark.createDataFrame(rows, "name string, raw string"))
    return {row["name"]: row for row in frame.collect()}


@pytest.mark.parametrize("name,error", [(c[0], c[2]) for c in CASES])
def test_first_error(judged, name, error):
    row = judged[name]
    assert row["error"] == error
    assert (row["order_id"] is None) == (error is not None)
    assert (row["payload_hash"] is None) == (error is not None)


def test_canonical_values(judged):
    row = judged["valid"]
    assert row["updated_at"] == datetime(2025, 5, 2, 9, 45)
    assert row["total_amount"] == Decimal("37.50")
    assert row["lines"][0].asDict() == {
        "line_id": "ord-a/1",
        "product_name": "Desk lamp",
        "sku": "DL-9",
        "quantity": 3,
        "unit_amount": Decimal("12.50"),
        "line_amount": Decimal("37.50"),
    }
    assert json.loads(row["payload_json"])["updated_at"] == "2025-05-02T09:45:00Z"
    assert judged["sku null"]["lines"][0]["sku"] is None
    assert judged["nan inside texts"]["order_number"] == 'NaN "\\" Infinity\\'
    assert judged["ignored nan"]["payload_hash"] == row["payload_hash"]
    assert judged["updated other zone"]["updated_at"] == datetime(2026, 1, 15, 10)


def test_equal_orders_hash_equal(spark, order):
    a, b = order(), order()
    a["lines"].append(LINE)
    b["lines"].insert(0, dict(reversed(LINE.items())))
    b["created"] = "2025-05-02T09:15:00+01:00"
    b["total"]["gross"]["amount"] = 37.5
    repeated = json.dumps(a).replace('"number": "A/17"', '"number": "old", "number": "A/17"')
    rows = [(json.dumps(a),), (json.dumps(b),), (repeated,)]
    frame = contract.judge(spark.createDataFrame(rows, "raw string"))
    assert frame.select("payload_hash").distinct().count() == 1


def test_filters_do_not_repeat_the_parse(spark):
    frame = contract.judge(spark.createDataFrame([("{}",)], "raw string"))
    plan = frame.filter(F.col("error").isNull())._jdf.queryExecution().optimizedPlan().toString()
    # Once to read the values and once for the rows that broke a rule; each has a second try.
    assert plan.count("parseJson") == 4


def test_long_orders_stay_linear(spark):
    """Ten thousand lines, one of them repeated at the end."""
    lines = [{**LINE, "id": f"x{i}"} for i in range(10000)]
    from conftest import ORDER

    good, bad = {**ORDER, "lines": lines}, {**ORDER, "lines": [*lines, LINE, LINE]}
    frame = spark.createDataFrame([(json.dumps(o),) for o in (good, bad)], "raw string")
    errors = [row["error"] for row in contract.judge(frame).select("error").collect()]
    assert errors == [None, "line IDs must be unique strings"]


def test_odd_literals_are_searched_once_a_line(spark):
    """All that stands outside of strings is searched together; texts and empty pieces stay."""
    nines = "9" * 400
    lines = {
        '{"a":NaN,"b":"NaN","c":[-Infinity,"",Infinity]}': '{"a":1e300,"b":"NaN","c":[1e300,"",1e300]}',
        f'{{"a":{nines},"b":"{nines}","c":{nines}.5}}': f'{{"a":1e300,"b":"{nines}","c":1e300}}',
        f'{{"NaN \\" -Infinity":0.{nines}1e00000000012345,"":"\\\\"}}': (
            f'{{"NaN \\" -Infinity":0.{nines[:100]}e1234,"":"\\\\"}}'
        ),
        '"NaN"': '"NaN"',
        "NaN": "1e300",
        "xNaN": "xNaN",
        "": "",
        "a\x01NaN": None,
    }
    frame = spark.createDataFrame([(x,) for x in lines], "raw string")
    plain = json_values.with_plain_literals(F.col("raw"))
    assert {r.raw: r.plain for r in frame.select("raw", plain.alias("plain")).collect()} == lines
    # Not one search for each piece between two quotes.
    tree = frame.select(plain)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_join(filter(" in tree


def test_a_value_that_messages_need_is_read_once(spark):
    """Each mention of a path in the plan is one more walk into the document of a bad row."""
    lines = spark.createDataFrame([("x",)], "raw string")
    plan = contract.judge(lines)._jdf.queryExecution().analyzed().toString()
    assert plan.count("$[0].channel") == 1
    assert plan.count("$[0].lines") <= 9


def test_objects_are_told_from_other_values(spark):
    texts = ["{}", '{"_":1}', '{"_":{"a":1}}', '{"_":null}', "[]", "[{}]", "1", "1.5", '"x"', "true", "null"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("v", F.try_parse_json("t"))
    told = rows.select("t", json_values.is_object(F.col("v")).alias("whole")).collect()
    assert [r["t"] for r in told if r["whole"]] == texts[:4]


def test_filled_text_is_that_of_the_formatter(spark):
    rows = spark.createDataFrame([(-1, "a %s\\", 2.5), (None, None, None)], "n bigint, t string, d double")
    values = [F.col("n"), F.col("t"), F.col("d").cast("decimal(18,2)").cast("string")]
    both = rows.select(
        queries._filled('{%s,"%s",%s}', *values).alias("ours"),
        F.format_string('{%d,"%s",%s}', *values).alias("theirs"),
    )
    assert all(row["ours"] == row["theirs"] for row in both.collect())
    assert "format_string" not in queries._filled("%s", F.col("n"))._jc.toString()
