"""Data tests over current tables; each returns its failing rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators import metrics
from orderloom.schemas import CURRENCIES, MINIMUM_TESTS, STATUSES


def null_keys(table: DataFrame, key: str) -> DataFrame:
    """Rows without a key."""
    return table.filter(F.col(key).isNull())


def repeated_keys(table: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return (
        table.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def unaccepted_currencies(orders: DataFrame) -> DataFrame:
    """Currencies outside the accepted set and how often each occurs; null passes."""
    return (
        orders.filter(~F.col("currency").isin(*CURRENCIES))
        .groupBy("currency")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def orphan_lines(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Order IDs of lines without an order, with the number of such lines.

    Lines are counted per order first: one row per order meets the join, however many
    lines an order has, and the join reuses that shuffle.
    """
    counted = (
        lines.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    return counted.join(orders.select("order_id"), "order_id", "left_anti")


def order_contract(orders: DataFrame) -> DataFrame:
    """Orders updated before creation, with a negative total or an unknown status."""
    return orders.filter(_order_broken())


def _order_broken():
    return (
        (F.col("updated_at") < F.col("created_at"))
        | (F.col("total_amount") < 0)
        | ~F.col("status").isin(*STATUSES)
    )


def line_contract(lines: DataFrame) -> DataFrame:
    """Lines with a quantity below one or a negative amount."""
    return lines.filter(_line_broken())


def _line_broken():
    return (F.col("quantity") <= 0) | (F.col("unit_amount") < 0) | (F.col("line_amount") < 0)


def conflicting_versions(versions: DataFrame) -> DataFrame:
    """Source versions with more than one payload, across all snapshots.

    The smallest and the largest hash combine map-side, so one shuffle is enough.
    """
    return (
        versions.groupBy("order_id", "updated_at")
        .agg(F.min("payload_hash").alias("least"), F.max("payload_hash").alias("most"))
        .filter(F.col("least") != F.col("most"))
        .select("order_id", "updated_at")
    )


def reconcile_daily(orders: DataFrame, daily: DataFrame) -> DataFrame:
    """Days whose stored count or gross differs from one recomputed from orders."""
    expected = metrics.daily_order_metrics(orders).alias("expected")
    actual = daily.alias("actual")
    joined = expected.join(actual, list(metrics.ORDER_GROUP), "full")

    def differs(name):
        return ~F.col(f"expected.{name}").eqNullSafe(F.col(f"actual.{name}"))

    return joined.filter(differs("order_count") | differs("gross_amount")).select("order_date")


def suite(
    versions: DataFrame, orders: DataFrame, lines: DataFrame, daily: DataFrame
) -> DataFrame:
    """All ten tests as rows ``(test_name, failures, passed)``.

    Row checks of a table share one scan of it.
    """
    order_rows = orders.agg(
        F.count_if(F.col("order_id").isNull()).alias("orders_order_id_not_null"),
        F.count_if(_order_broken()).alias("order_contract"),
    )
    line_rows = lines.agg(
        F.count_if(F.col("line_id").isNull()).alias("order_lines_line_id_not_null"),
        F.count_if(_line_broken()).alias("line_contract"),
    )
    row_checks = [_as_rows(order_rows), _as_rows(line_rows)]
    others = {
        "orders_order_id_unique": repeated_keys(orders, "order_id"),
        "orders_currency_accepted": unaccepted_currencies(orders),
        "order_lines_line_id_unique": repeated_keys(lines, "line_id"),
        "no_conflicting_versions": conflicting_versions(versions),
        "reconcile_daily_order_metrics": reconcile_daily(orders, daily),
    }
    counts = [
        df.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(name).alias("test_name"), "failures"
        )
        for name, df in others.items()
    ]
    orphans = (
        orphan_lines(lines, orders)
        .agg(F.coalesce(F.sum("n_records"), F.lit(0)).cast("bigint").alias("failures"))
        .select(F.lit("order_lines_order_id_in_orders").alias("test_name"), "failures")
    )
    results = reduce(DataFrame.unionByName, [*row_checks, *counts, orphans])
    return results.withColumn("passed", F.col("failures") == 0)


def _as_rows(counts: DataFrame) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("test_name"), F.col(c).alias("failures")) for c in counts.columns]
    return counts.select(F.inline(F.array(*pairs)))


def evidence(results: DataFrame, minimum: int = MINIMUM_TESTS) -> DataFrame:
    """One row: tests run, tests passed and whether that is enough to publish."""
    return results.agg(
        F.count(F.lit(1)).alias("tests_run"),
        F.count_if("passed").alias("tests_passed"),
    ).withColumn(
        "validated",
        (F.col("tests_run") >= minimum) & (F.col("tests_run") == F.col("tests_passed")),
    )
