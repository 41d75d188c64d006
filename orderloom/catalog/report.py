"""Report queries over the daily metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.catalog import current, views
from orderloom.catalog.inventory import _clock, _iso, _pointer
from orderloom.catalog.views import with_views
from orderloom.operators import report

_FILTER = {
    "currency": "USD",
    "channels": ["BUILDING", "MACHINERY"],
    "start": "1996-01-01",
    "end": "1998-12-31",
}


def _daily(spark, folder):
    return report.selected(current.daily_order_metrics(spark, folder), **_FILTER)


def report_headline(spark, folder):
    return report.headline(_daily(spark, folder))


_SELECTIONS = {
    "all of a currency": ("EUR", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]),
    "one channel": ("PLN", ["FURNITURE"]),
    "some days": ("USD", ["BUILDING"], "1997-01-01", "1997-01-31"),
    "no channel": ("USD", []),
    "unknown currency": ("GBP", ["BUILDING"]),
}


def report_selections(spark, folder):
    """Headlines of several selections, empty ones among them."""
    daily = current.daily_order_metrics(spark, folder)
    parts = [
        report.headline(report.selected(daily, *chosen)).withColumn("selection", F.lit(name))
        for name, chosen in _SELECTIONS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def report_trend(spark, folder):
    return report.trend(_daily(spark, folder))


def report_top_products(spark, folder):
    products = current.daily_product_metrics(spark, folder)
    return report.top_products(report.selected(products, **_FILTER))


def report_options(spark, folder):
    return report.options(current.daily_order_metrics(spark, folder))


def report_date_bounds(spark, folder):
    return report.date_bounds(_daily(spark, folder))


def report_quality(spark, folder):
    return report.quality_line(_pointer(spark, folder), _clock("2024-01-31 12:00:00"))


QUERIES = {
    "report_headline": report_headline,
    "report_selections": report_selections,
    "report_trend": report_trend,
    "report_top_products": report_top_products,
    "report_options": report_options,
    "report_date_bounds": report_date_bounds,
    "report_quality": report_quality,
}

_WHERE = """WHERE currency = 'USD' AND channel IN ('BUILDING', 'MACHINERY')
          AND order_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'"""

SQL = {
    "report_headline": with_views(
        views.DAILY,
        f"""
        SELECT CAST(sum(order_count) AS BIGINT) AS order_count,
          CAST(sum(gross_amount) AS DECIMAL(38,2)) AS gross_amount,
          format('{{:,.2f}}', CAST(sum(gross_amount) AS DOUBLE)) AS gross_text
        FROM daily_v {_WHERE}""",
    ),
    "report_selections": with_views(
        views.DAILY,
        " UNION ALL ".join(
            f"""
        SELECT '{name}' AS selection, CAST(coalesce(sum(order_count), 0) AS BIGINT) AS order_count,
          CAST(coalesce(sum(gross_amount), 0) AS DECIMAL(38,2)) AS gross_amount,
          format('{{:,.2f}}', CAST(coalesce(sum(gross_amount), 0) AS DOUBLE)) AS gross_text
        FROM daily_v WHERE {condition}"""
            for name, condition in {
                "all of a currency": "currency = 'EUR'",
                "one channel": "currency = 'PLN' AND channel = 'FURNITURE'",
                "some days": "currency = 'USD' AND channel = 'BUILDING' AND order_date >= "
                "DATE '1997-01-01' AND order_date <= DATE '1997-01-31'",
                "no channel": "false",
                "unknown currency": "currency = 'GBP'",
            }.items()
        ),
    ),
    "report_trend": with_views(views.DAILY, f"SELECT * FROM daily_v {_WHERE}"),
    "report_top_products": with_views(
        views.PRODUCTS,
        f"""
        SELECT sku, product_name, CAST(sum(gross_amount) AS DECIMAL(38,2)) AS gross_amount
        FROM products_v {_WHERE} GROUP BY 1, 2
        ORDER BY gross_amount DESC, sku NULLS LAST, product_name LIMIT 10""",
    ),
    "report_options": with_views(
        views.DAILY,
        """
        SELECT DISTINCT 'currency' AS kind, currency AS value FROM daily_v
        UNION ALL SELECT DISTINCT 'channel', channel FROM daily_v""",
    ),
    "report_date_bounds": with_views(
        views.DAILY,
        f"""
        SELECT min(order_date) AS first_date, max(order_date) AS last_date, count(*) = 0 AS is_empty,
          min(order_date) = max(order_date) AS is_single_day FROM daily_v {_WHERE}""",
    ),
    "report_quality": f"""
        WITH pointer_v AS (
          SELECT max(ts) FILTER (event_type = 'purchase') AS first_at,
            count(*) FILTER (event_type = 'error') AS rejected_count,
            count(*) FILTER (event_type = 'view') AS duplicate_count FROM events),
        age_v AS (
          SELECT *, (epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(first_at)) / 3600000000.0 AS a
          FROM pointer_v)
        SELECT 'r1' AS release_id, {_iso('first_at')} AS published_at,
          CAST(a AS DOUBLE) AS publication_age_hours, a > 24 AS is_stale,
          CAST(10 AS INTEGER) AS data_tests_passed, rejected_count, duplicate_count FROM age_v""",
}
