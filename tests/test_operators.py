"""Classification, scans, reports and plan shapes on small and skewed input."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom import session
from orderloom.operators import dedup, history, metrics, quality, report, skew, windows
from orderloom.sources.text_lines import read_lines


def brute_force(rows):
    first, outcomes = {}, {}
    for key, order, hour, payload, error in sorted(rows):
        if error:
            outcomes[key] = "invalid"
        elif (order, hour) not in first:
            first[(order, hour)] = payload
            outcomes[key] = "accepted"
        else:
            outcomes[key] = "duplicate" if first[(order, hour)] == payload else "conflict"
    return outcomes


@pytest.mark.parametrize("hot_rows", [1, 50, 10**6])
def test_classification_with_a_hot_key(spark, hot_rows):
    chance = random.Random(7)
    rows = []
    for key in range(3000):
        hot = chance.random() < 0.4
        order, hour = ("hot", 0) if hot else (f"o{chance.randrange(400)}", chance.randrange(3))
        error = "bad" if chance.random() < 0.1 else None
        rows.append((key, order, hour, f"p{chance.randrange(3)}", error))
    chance.shuffle(rows)
    frame = spark.createDataFrame(
        [(k, o, datetime(2026, 1, 1, h), p, e) for k, o, h, p, e in rows],
        "line_key bigint, order_id string, updated_at timestamp_ntz, payload_hash string, error string",
    )
    got = dedup.classify(frame, hot_rows=hot_rows).select("line_key", "outcome").collect()
    assert {r["line_key"]: r["outcome"] for r in got} == brute_force(rows)
    assert len(got) == 3000


def test_hot_rows_are_spread_in_the_shuffle(spark):
    """Rows of a hot key must not meet in one task of the classifying join."""
    frame = spark.range(40000).select(
        F.col("id").alias("line_key"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("order_id"),
        F.lit("2026-01-01").cast("timestamp_ntz").alias("updated_at"),
        F.lit("p").alias("payload_hash"),
        F.lit(None).cast("string").alias("error"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        done = dedup.classify(frame, hot_rows=1000)
        plan = done._jdf.queryExecution().executedPlan().toString()
        per_task = done.groupBy(F.spark_partition_id()).count().collect()
        assert done.filter("outcome = 'accepted'").count() == 26667
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert "ReusedExchange" in plan
    assert max(row["count"] for row in per_task) < 40000 / 8 * 1.2


def test_same_key_in_two_batches_is_no_duplicate(spark):
    rows = [("s1", 0, "o", "p", None), ("s2", 0, "o", "q", None), ("s1", 1, "o", "p", None)]
    frame = spark.createDataFrame(
        rows, "snapshot_id string, line_key bigint, order_id string, payload_hash string, error string"
    ).withColumn("updated_at", F.lit("2026-01-01").cast("timestamp_ntz"))
    got = dedup.classify(frame, batch=("snapshot_id",)).collect()
    assert sorted((r["snapshot_id"], r["line_key"], r["outcome"]) for r in got) == [
        ("s1", 0, "accepted"),
        ("s1", 1, "duplicate"),
        ("s2", 0, "accepted"),
    ]


def test_line_numbers_over_many_splits(spark, tmp_path):
    chance = random.Random(3)
    for name in ("a", "b", "c"):
        lines = ["" if chance.random() < 0.2 else f"{name}{i} " + "x" * chance.randrange(60) for i in range(400)]
        end = "\r\n" if name == "b" else "\n"
        (tmp_path / f"{name}.jsonl").write_text(end.join(lines) + end, encoding="utf-8", newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        got = read_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected, key = set(), 0
    for name in ("a", "b", "c"):
        text = (tmp_path / f"{name}.jsonl").read_text(encoding="utf-8")
        for number, line in enumerate(text.splitlines(), 1):
            if line.strip():
                expected.add((name, number, key, line))
            key += 1
    assert {(r["source_file"][-7], r["line_number"], r["line_key"], r["raw"]) for r in got} == expected


def versions(spark, *rows):
    schema = (
        "order_id string, updated_at timestamp_ntz, snapshot_id string, payload_json string, "
        "payload_hash string, lines array<struct<line_id string, product_name string, sku string, "
        "quantity int, unit_amount decimal(18,2), line_amount decimal(18,2)>>"
    )
    one = Decimal("1.00")
    return spark.createDataFrame(
        [
            (o, datetime(2026, 1, d), s, p, p, [(line, "n", None, 1, one, one) for line in lines])
            for o, d, s, p, lines in rows
        ],
        schema,
    )


def test_both_line_plans_agree_and_lines_never_double(spark):
    history_rows = versions(
        spark,
        ("a", 1, "s1", "p1", ["1", "2"]),
        ("a", 2, "s2", "p2", ["1"]),
        ("a", 2, "s3", "p2", ["1"]),  # the same version again
        ("a", 1, "s4", "p1", ["1", "2"]),  # late, must not roll back
        ("b", 1, "s1", "p3", ["3"]),
    )
    orders = history.current_orders(history_rows)
    assert {(r["order_id"], r["snapshot_id"]) for r in orders.collect()} == {("a", "s3"), ("b", "s1")}
    joined = history.current_order_lines(history.line_versions(history_rows), orders)
    nested = history.lines_of(orders)
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, nested.collect()), key=str)
    assert sorted(r["line_id"] for r in nested.collect()) == ["1", "3"]


def test_ranking_limits_rows_before_the_shuffle(spark):
    plan = history.current_orders(
        versions(spark, ("a", 1, "s1", "p", ["1"])).drop("lines")
    )._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange") == 1


def test_window_bounds_reach_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    window = {"mode": "backfill", "lower": "1996-03-01T00:00:00+00:00", "upper": "1996-04-01T00:00:00+00:00"}
    read = windows.read_window(orders, window, "o_orderdate")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_report_filter(spark):
    rows = [("USD", "a", 15, 20), ("PLN", "a", 15, 100), ("USD", "b", 15, 30), ("USD", "a", 18, 5), ("USD", "a", 16, 7)]
    daily = spark.createDataFrame(
        [(c, ch, date(2026, 1, d), g, 1) for c, ch, d, g in rows],
        "currency string, channel string, order_date date, gross_amount int, order_count int",
    )
    total = report.headline(report.selected(daily, "USD", ["a"], "2026-01-01", "2026-01-15")).first()
    assert (total["gross_amount"], total["order_count"]) == (20, 1)
    assert report.selected(daily, "USD", []).isEmpty()
    nothing = report.headline(report.selected(daily, "USD", None)).first()
    assert (nothing["gross_amount"], nothing["gross_text"]) == (0, "0.00")
    days = [r["order_date"].day for r in report.trend(report.selected(daily, "USD", ["a"])).collect()]
    assert days == [15, 16, 18]
    bounds = report.date_bounds(report.selected(daily, "USD", ["b"])).first()
    assert bounds["is_single_day"] and not bounds["is_empty"]


def test_top_products_keep_missing_skus_apart(spark):
    rows = [(None, "n", 5), ("s", "n", 5), ("s", "m", 5), (None, "n", 1)]
    products = spark.createDataFrame(rows, "sku string, product_name string, gross_amount int")
    top = [(r["sku"], r["product_name"]) for r in report.top_products(products, 3).collect()]
    assert top == [(None, "n"), ("s", "m"), ("s", "n")]


def test_suite_finds_each_fault(spark):
    day = datetime(2026, 1, 2)
    orders = spark.createDataFrame(
        [
            ("a", day, day, "DRAFT", "c", "USD", Decimal(1)),
            ("a", day, day, "FULFILLED", "c", "GBP", Decimal(1)),
            (None, day, datetime(2026, 1, 1), "FULFILLED", "c", None, Decimal(1)),
        ],
        "order_id string, created_at timestamp_ntz, updated_at timestamp_ntz, status string, "
        "channel string, currency string, total_amount decimal(18,2)",
    )
    lines = spark.createDataFrame(
        [("a", "1", 1), ("z", "1", 1), ("z", None, 0)], "order_id string, line_id string, quantity int"
    ).withColumns({c: F.lit(1).cast("decimal(18,2)") for c in ("unit_amount", "line_amount")})
    stored = versions(spark, ("a", 1, "s1", "p", []), ("a", 1, "s2", "q", []), ("b", 1, "s1", "p", []))
    daily = metrics.daily_order_metrics(orders).filter("currency is not null")
    results = {r["test_name"]: r["failures"] for r in quality.suite(stored, orders, lines, daily).collect()}
    assert results == {
        "orders_order_id_not_null": 1,
        "orders_order_id_unique": 1,
        "orders_currency_accepted": 1,
        "order_lines_line_id_not_null": 1,
        "order_lines_line_id_unique": 1,
        "order_lines_order_id_in_orders": 2,
        "order_contract": 1,
        "line_contract": 1,
        "no_conflicting_versions": 1,
        # The null currency never matches, so both sides' groups of it differ.
        "reconcile_daily_order_metrics": 1,
    }


def test_shuffle_tasks_follow_the_input_size(spark, monkeypatch):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    lineitem = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    with session.shuffles_for(lineitem):
        assert spark.conf.get(key) == before
    monkeypatch.setattr(session, "BYTES_PER_TASK", 100_000)
    with session.shuffles_for(lineitem):
        assert int(spark.conf.get(key)) > int(before)
    assert spark.conf.get(key) == before


@pytest.mark.parametrize("most", [0, 10])
def test_matching_rows_by_broadcast_and_by_salt(spark, monkeypatch, most):
    monkeypatch.setattr(skew, "MAX_HOT_KEYS", most)
    rows = spark.range(3000).select(
        F.col("id").cast("string").alias("order_id"),
        F.when(F.col("id") % 3 > 0, "s1").otherwise(F.concat(F.lit("t"), F.col("id") % 9)).alias("key"),
    )
    wanted = spark.createDataFrame([("s1",), ("t3",), ("absent",)], "key string")
    got = skew.keep_matching_few(rows, wanted, ["key"], "order_id").groupBy("key").count().collect()
    assert {r["key"]: r["count"] for r in got} == {"s1": 2000, "t3": 333}
