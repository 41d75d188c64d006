"""Daily order and product metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.schemas import SUM_MONEY, UNCOUNTED_STATUSES

ORDER_GROUP = ("order_date", "channel", "currency")
PRODUCT_GROUP = (*ORDER_GROUP, "sku", "product_name")


def counted(orders: DataFrame) -> DataFrame:
    """Orders that count in metrics, with their UTC creation day."""
    return orders.filter(~F.col("status").isin(*UNCOUNTED_STATUSES)).withColumn(
        "order_date", F.to_date("created_at")
    )


def daily_order_metrics(orders: DataFrame) -> DataFrame:
    """Orders, gross and average order value per day, channel and currency."""
    gross = F.sum("total_amount").cast(SUM_MONEY)
    return (
        counted(orders)
        .groupBy(*ORDER_GROUP)
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            gross.alias("gross_amount"),
            (gross.cast("double") / F.count("total_amount")).alias("average_order_value"),
        )
    )


def _product_totals(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*PRODUCT_GROUP).agg(
        F.sum("quantity").cast("bigint").alias("units_ordered"),
        F.sum("line_amount").cast(SUM_MONEY).alias("gross_amount"),
    )


def daily_product_metrics(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Units and gross of lines per day, channel, currency, sku and product name."""
    heads = counted(orders).select("order_id", *ORDER_GROUP)
    return _product_totals(lines.join(heads, "order_id"))


def daily_product_metrics_nested(orders: DataFrame) -> DataFrame:
    """The same from orders that carry their lines nested: no join."""
    return _product_totals(counted(orders).select(*ORDER_GROUP, F.inline("lines")))


def _totalled(rows: DataFrame, groups: tuple[str, ...], number: str) -> DataFrame:
    totals = rows.groupBy(*groups).agg(
        F.sum(number).cast("bigint").alias(number), F.sum("gross_amount").cast(SUM_MONEY).alias("gross_amount")
    )
    return totals.filter(F.col(number) != 0)


def maintained_daily(before: DataFrame, retracted: DataFrame, added: DataFrame) -> DataFrame:
    """Daily order metrics after some orders were replaced: old versions out, new ones in.

    ``before`` are the metrics so far; a group without orders left goes.
    """

    def signed(orders: DataFrame, sign: int) -> DataFrame:
        gross = (F.col("total_amount") * sign).cast(SUM_MONEY).alias("gross_amount")
        return counted(orders).select(*ORDER_GROUP, F.lit(sign).cast("bigint").alias("order_count"), gross)

    rows = before.select(*ORDER_GROUP, "order_count", "gross_amount")
    totals = _totalled(
        rows.unionByName(signed(retracted, -1)).unionByName(signed(added, 1)), ORDER_GROUP, "order_count"
    )
    average = F.col("gross_amount").cast("double") / F.col("order_count")
    return totals.withColumn("average_order_value", average)


def maintained_products(before: DataFrame, retracted: DataFrame, added: DataFrame) -> DataFrame:
    """Daily product metrics likewise, from orders that carry their lines nested.

    Every line has a quantity of at least one, so a group without units has no lines left.
    """

    def signed(orders: DataFrame, sign: int) -> DataFrame:
        lines = counted(orders).select(*ORDER_GROUP, F.inline("lines"))
        units = (F.col("quantity").cast("bigint") * sign).alias("units_ordered")
        gross = (F.col("line_amount") * sign).cast(SUM_MONEY).alias("gross_amount")
        return lines.select(*PRODUCT_GROUP, units, gross)

    rows = before.select(*PRODUCT_GROUP, "units_ordered", "gross_amount")
    return _totalled(
        rows.unionByName(signed(retracted, -1)).unionByName(signed(added, 1)), PRODUCT_GROUP, "units_ordered"
    )
