"""Metrics, current state and data tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.catalog import views
from orderloom.catalog.views import with_views
from orderloom.operators import history, metrics, quality
from orderloom.session import materialize
from orderloom.sources import star_tables as star


def daily_order_metrics(spark, folder):
    return metrics.daily_order_metrics(star.orders(spark, folder))


def daily_product_metrics(spark, folder):
    return metrics.daily_product_metrics(
        star.order_lines(spark, folder), star.orders(spark, folder)
    )


_ORDER_COLUMNS = (
    "order_id",
    "updated_at",
    "snapshot_id",
    "status",
    "channel",
    "currency",
    "total_amount",
    "payload_hash",
)
_LINE_COLUMNS = (
    "order_id",
    "line_id",
    "product_name",
    "sku",
    "quantity",
    "unit_amount",
    "line_amount",
    "snapshot_id",
    "payload_hash",
)


def _current(spark, folder):
    return history.current_orders(star.order_versions(spark, folder))


def current_orders(spark, folder):
    return _current(spark, folder).select(*_ORDER_COLUMNS)


def current_order_lines(spark, folder):
    versions = star.order_versions(spark, folder)
    orders = history.current_orders(history.order_versions(versions))
    lines = history.line_versions(versions)
    return history.current_order_lines(lines, orders).select(*_LINE_COLUMNS)


def staging_orders(spark, folder):
    versions = history.order_versions(star.order_versions(spark, folder))
    return versions.drop("payload_json", "order_number")


def staging_lines(spark, folder):
    return history.line_versions(star.order_versions(spark, folder))


def current_lines_nested(spark, folder):
    return history.lines_of(_current(spark, folder)).select(*_LINE_COLUMNS)


def daily_products_nested(spark, folder):
    return metrics.daily_product_metrics_nested(_current(spark, folder))


def removed_lines(spark, folder):
    """Line IDs of older versions that the current version no longer has."""
    versions = star.order_versions(spark, folder)
    keys = ["order_id", "line_id"]
    old = history.line_versions(versions).select(*keys).distinct()
    return old.join(current_lines_nested(spark, folder).select(*keys), keys, "left_anti")


def late_versions(spark, folder):
    """Versions that came in a later snapshot than the current one but are older."""
    # Stored, so that the join has an exchange on each side and the runtime can split an order
    # with very many versions.
    current = materialize(
        current_orders(spark, folder).select(
            "order_id",
            F.col("snapshot_id").alias("current_snapshot"),
            F.col("updated_at").alias("current_updated_at"),
        ),
        "current-versions",
    )
    versions = star.order_versions(spark, folder).select("order_id", "snapshot_id", "updated_at")
    late = versions.groupBy("order_id", "snapshot_id", "updated_at").agg(
        F.count(F.lit(1)).alias("n_records")
    )
    return (
        late.join(current, "order_id")
        .filter(
            (F.col("snapshot_id") > F.col("current_snapshot"))
            & (F.col("updated_at") < F.col("current_updated_at"))
        )
        .select("order_id", "snapshot_id", "updated_at", "n_records")
    )


def _faulty_orders(spark, folder):
    """Orders with some updates before creation, unknown statuses and a foreign currency."""
    key = F.col("order_id").cast("bigint")
    return star.orders(spark, folder).withColumns(
        {
            "updated_at": F.expr("created_at + make_dt_interval(0, cast(cast(order_id as bigint) % 20 - 1 as int))"),
            "status": F.when(key % 11 == 0, "LOST").otherwise(F.col("status")),
            "currency": F.when(F.col("channel") == "BUILDING", "GBP").otherwise(F.col("currency")),
        }
    )


def null_keys(spark, folder):
    return quality.null_keys(star.order_lines(spark, folder), "sku").select(
        "order_id", "line_id", "quantity", "line_amount"
    )


def repeated_line_ids(spark, folder):
    return quality.repeated_keys(star.order_lines(spark, folder), "line_id")


def repeated_order_ids(spark, folder):
    return quality.repeated_keys(
        star.order_versions(spark, folder).select("order_id"), "order_id"
    )


def unaccepted_currencies(spark, folder):
    return quality.unaccepted_currencies(_faulty_orders(spark, folder))


def orphan_lines(spark, folder):
    counted = metrics.counted(star.orders(spark, folder))
    return quality.orphan_lines(star.order_lines(spark, folder), counted)


def order_contract(spark, folder):
    return quality.order_contract(_faulty_orders(spark, folder)).select("order_id")


def line_contract(spark, folder):
    lines = star.order_lines(spark, folder).withColumn(
        "line_amount", F.col("line_amount") - F.lit(1000).cast("decimal(18,2)")
    )
    return quality.line_contract(lines).select("order_id", "line_id", "line_amount")


def conflicting_versions(spark, folder):
    return quality.conflicting_versions(star.order_versions(spark, folder))


def _shifted_daily(spark, folder):
    """Stored metrics in which one channel is off by one and another is missing."""
    shift = F.when(F.col("channel") == "BUILDING", 1).otherwise(0)
    return (
        daily_order_metrics(spark, folder)
        .withColumn("gross_amount", (F.col("gross_amount") + shift).cast("decimal(38,2)"))
        .filter(F.col("channel") != "MACHINERY")
    )


def reconcile_daily(spark, folder):
    return quality.reconcile_daily(star.orders(spark, folder), _shifted_daily(spark, folder))


def data_test_suite(spark, folder):
    return quality.suite(
        star.order_versions(spark, folder),
        star.orders(spark, folder),
        star.order_lines(spark, folder),
        _shifted_daily(spark, folder),
    )


def data_test_evidence(spark, folder):
    return quality.evidence(data_test_suite(spark, folder))


_SUITE = """
suite_v AS (
  SELECT 'orders_order_id_not_null' AS test_name, count(*) FILTER (order_id IS NULL) AS failures FROM orders_v
  UNION ALL SELECT 'orders_order_id_unique', (SELECT count(*) FROM (
    SELECT order_id FROM orders_v GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'orders_currency_accepted', (SELECT count(DISTINCT currency) FROM orders_v
    WHERE currency NOT IN ('USD', 'EUR', 'PLN'))
  UNION ALL SELECT 'order_lines_line_id_not_null', count(*) FILTER (line_id IS NULL) FROM lines_v
  UNION ALL SELECT 'order_lines_line_id_unique', (SELECT count(*) FROM (
    SELECT line_id FROM lines_v GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'order_lines_order_id_in_orders', (SELECT count(*) FROM lines_v
    WHERE order_id NOT IN (SELECT order_id FROM orders_v))
  UNION ALL SELECT 'order_contract', count(*) FILTER (updated_at < created_at OR total_amount < 0
    OR status NOT IN ('DRAFT', 'UNFULFILLED', 'FULFILLED', 'CANCELED')) FROM orders_v
  UNION ALL SELECT 'line_contract', count(*) FILTER (
    quantity <= 0 OR unit_amount < 0 OR line_amount < 0) FROM lines_v
  UNION ALL SELECT 'no_conflicting_versions', (SELECT count(*) FROM (SELECT order_id, updated_at
    FROM versions_v GROUP BY 1, 2 HAVING count(DISTINCT payload_hash) > 1))
  UNION ALL SELECT 'reconcile_daily_order_metrics', count(*) FROM daily_v
    WHERE channel IN ('BUILDING', 'MACHINERY'))"""
_SUITE_VIEWS = f"{views.DAILY}, {views.LINES}, {views.VERSIONS}, {_SUITE}"

QUERIES = {
    "daily_order_metrics": daily_order_metrics,
    "daily_product_metrics": daily_product_metrics,
    "staging_orders": staging_orders,
    "staging_lines": staging_lines,
    "current_orders": current_orders,
    "current_order_lines": current_order_lines,
    "current_lines_nested": current_lines_nested,
    "daily_products_nested": daily_products_nested,
    "removed_lines": removed_lines,
    "late_versions": late_versions,
    "null_keys": null_keys,
    "repeated_line_ids": repeated_line_ids,
    "repeated_order_ids": repeated_order_ids,
    "unaccepted_currencies": unaccepted_currencies,
    "orphan_lines": orphan_lines,
    "order_contract": order_contract,
    "line_contract": line_contract,
    "conflicting_versions": conflicting_versions,
    "reconcile_daily": reconcile_daily,
    "data_test_suite": data_test_suite,
    "data_test_evidence": data_test_evidence,
}

SQL = {
    "daily_order_metrics": with_views(views.DAILY, "SELECT * FROM daily_v"),
    "daily_product_metrics": with_views(views.PRODUCTS, "SELECT * FROM products_v"),
    "staging_orders": with_views(
        views.VERSIONS,
        f"SELECT {', '.join(_ORDER_COLUMNS)}, created_at FROM versions_v",
    ),
    "staging_lines": with_views(
        views.VERSION_LINES, f"SELECT {', '.join(_LINE_COLUMNS)} FROM version_lines_v"
    ),
    "current_orders": with_views(
        views.CURRENT, f"SELECT {', '.join(_ORDER_COLUMNS)} FROM current_v"
    ),
    "current_order_lines": with_views(
        views.CURRENT, f"SELECT {', '.join(_LINE_COLUMNS)} FROM current_lines_v"
    ),
    "current_lines_nested": with_views(
        views.CURRENT,
        f"SELECT {', '.join(f'l.{c}' for c in _LINE_COLUMNS)} "
        "FROM version_lines_v l JOIN current_v c ON l.event_id = c.event_id",
    ),
    "daily_products_nested": with_views(
        views.CURRENT,
        """
        SELECT CAST(c.created_at AS DATE) AS order_date, c.channel, c.currency, l.sku, l.product_name,
          CAST(sum(l.quantity) AS BIGINT) AS units_ordered,
          CAST(sum(l.line_amount) AS DECIMAL(38,2)) AS gross_amount
        FROM version_lines_v l JOIN current_v c ON l.event_id = c.event_id
        WHERE c.status NOT IN ('CANCELED', 'DRAFT') GROUP BY 1, 2, 3, 4, 5""",
    ),
    "removed_lines": with_views(
        views.CURRENT,
        """
        SELECT DISTINCT order_id, line_id FROM version_lines_v WHERE (order_id, line_id) NOT IN (
          SELECT (l.order_id, l.line_id) FROM version_lines_v l
          JOIN current_v c ON l.event_id = c.event_id)""",
    ),
    "late_versions": with_views(
        views.CURRENT,
        """
        SELECT v.order_id, v.snapshot_id, v.updated_at, count(*) AS n_records
        FROM versions_v v JOIN current_v c ON v.order_id = c.order_id
        WHERE v.snapshot_id > c.snapshot_id AND v.updated_at < c.updated_at GROUP BY 1, 2, 3""",
    ),
    "null_keys": with_views(
        views.LINES,
        "SELECT order_id, line_id, quantity, line_amount FROM lines_v WHERE sku IS NULL",
    ),
    "repeated_line_ids": with_views(
        views.LINES,
        "SELECT line_id, count(*) AS n_records FROM lines_v GROUP BY 1 HAVING count(*) > 1",
    ),
    "repeated_order_ids": with_views(
        views.VERSIONS,
        "SELECT order_id, count(*) AS n_records FROM versions_v GROUP BY 1 HAVING count(*) > 1",
    ),
    "unaccepted_currencies": with_views(
        views.ORDERS,
        "SELECT 'GBP' AS currency, count(*) AS n_records FROM orders_v WHERE channel = 'BUILDING'",
    ),
    "orphan_lines": with_views(
        f"{views.ORDERS}, {views.LINES}",
        """
        SELECT order_id, count(*) AS n_records FROM lines_v WHERE order_id NOT IN (
          SELECT order_id FROM orders_v WHERE status NOT IN ('CANCELED', 'DRAFT')) GROUP BY 1""",
    ),
    "order_contract": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderkey % 20 = 0 OR o_orderkey % 11 = 0""",
    "line_contract": with_views(
        views.LINES,
        """
        SELECT order_id, line_id, CAST(line_amount - 1000 AS DECIMAL(18,2)) AS line_amount
        FROM lines_v WHERE line_amount < 1000""",
    ),
    "conflicting_versions": with_views(
        views.VERSIONS,
        """
        SELECT order_id, updated_at FROM versions_v GROUP BY 1, 2
        HAVING count(DISTINCT payload_hash) > 1""",
    ),
    "reconcile_daily": with_views(
        views.DAILY,
        "SELECT order_date FROM daily_v WHERE channel IN ('BUILDING', 'MACHINERY')",
    ),
    "data_test_suite": with_views(
        _SUITE_VIEWS, "SELECT test_name, failures, failures = 0 AS passed FROM suite_v"
    ),
    "data_test_evidence": with_views(
        _SUITE_VIEWS,
        """
        SELECT count(*) AS tests_run, count(*) FILTER (failures = 0) AS tests_passed,
          count(*) >= 7 AND count(*) FILTER (failures > 0) = 0 AS validated FROM suite_v""",
    ),
}
