"""Report queries over the daily metrics of one release."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import timestamps
from orderloom.schemas import MAX_AGE_HOURS, SUM_MONEY


def selected(
    metrics: DataFrame,
    currency: str | None,
    channels: Iterable[str] | None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Rows of one currency in the given channels and days (bounds included).

    No channel selects no rows. The same filter serves both metric tables.
    """
    chosen = list(channels or [])
    condition = (F.col("currency") == F.lit(currency)) & (
        F.col("channel").isin(*chosen) if chosen else F.lit(False)
    )
    if start:
        condition &= F.col("order_date") >= F.to_date(F.lit(start))
    if end:
        condition &= F.col("order_date") <= F.to_date(F.lit(end))
    return metrics.filter(condition)


def headline(daily: DataFrame) -> DataFrame:
    """Total orders and gross of the selection; zeros when it is empty."""
    return daily.agg(
        F.coalesce(F.sum("order_count"), F.lit(0)).cast("bigint").alias("order_count"),
        F.coalesce(F.sum("gross_amount"), F.lit(0)).cast(SUM_MONEY).alias("gross_amount"),
    ).withColumn("gross_text", F.format_number("gross_amount", 2))


def trend(daily: DataFrame) -> DataFrame:
    """Selected rows, each channel in date order."""
    return daily.orderBy("channel", "order_date")


def top_products(products: DataFrame, count: int = 10) -> DataFrame:
    """Products with the highest gross; a missing sku is a group of its own."""
    return (
        products.groupBy("sku", "product_name")
        .agg(F.sum("gross_amount").cast(SUM_MONEY).alias("gross_amount"))
        .orderBy(F.col("gross_amount").desc(), F.asc_nulls_last("sku"), "product_name")
        .limit(count)
    )


def options(daily: DataFrame) -> DataFrame:
    """Distinct currencies and channels as sorted ``(kind, value)`` rows."""
    pairs = daily.select("currency", "channel").distinct()
    kinds = pairs.select(
        F.inline(
            F.array(
                F.struct(F.lit("currency").alias("kind"), F.col("currency").alias("value")),
                F.struct(F.lit("channel").alias("kind"), F.col("channel").alias("value")),
            )
        )
    )
    return kinds.distinct().orderBy("kind", "value")


def date_bounds(daily: DataFrame) -> DataFrame:
    """First and last day and whether the selection is empty or covers one day."""
    return daily.agg(
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
        (F.count(F.lit(1)) == 0).alias("is_empty"),
        F.coalesce(F.min("order_date") == F.max("order_date"), F.lit(False)).alias("is_single_day"),
    )


def quality_line(pointer: DataFrame, now: Column) -> DataFrame:
    """Release, age, staleness and evidence counts of the published release."""
    age = timestamps.age_hours(F.col("published_at"), now)
    return pointer.select(
        "release_id",
        "published_at",
        age.alias("publication_age_hours"),
        (age > MAX_AGE_HOURS).alias("is_stale"),
        "data_tests_passed",
        "rejected_count",
        "duplicate_count",
    )
