"""The order model over a TPC-H-like star schema and an event log.

These views feed the registered queries: the same operators run on them as on ingested
tables. Each covers its whole base table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import prepare, spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of the given folder."""
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


_CURRENCY = "CASE pmod(c_nationkey, 3) WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'PLN' END"


def _orders_with_customer(
    spark: SparkSession, folder: str, spread_by: str | None = None
) -> DataFrame:
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_mktsegment").alias("channel"),
        F.expr(_CURRENCY).alias("currency"),
    )
    base = table(spark, folder, "orders")
    if spread_by:
        base = spread(base, spread_by)
    return base.join(customers, "o_custkey")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Current orders: one per row of ``orders``."""
    return _orders_with_customer(spark, folder).select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        "channel",
        "currency",
        F.expr(
            "CASE WHEN o_orderkey % 7 = 0 THEN 'DRAFT' WHEN o_orderstatus = 'F' THEN 'FULFILLED' "
            "WHEN o_orderstatus = 'O' THEN 'UNFULFILLED' ELSE 'CANCELED' END"
        ).alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.expr("o_orderdate + make_dt_interval(0, o_orderkey % 48)").alias("updated_at"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total_amount"),
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Current order lines: one per row of ``lineitem``."""
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("unit_amount"),
    )
    return table(spark, folder, "lineitem").join(parts, "l_partkey").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_id"),
        "product_name",
        F.when(F.col("l_partkey") % 50 != 0, F.col("l_partkey").cast("string")).alias("sku"),
        F.col("l_quantity").cast("int").alias("quantity"),
        "unit_amount",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("line_amount"),
    )


def order_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Version history with nested lines: one version per row of ``events``.

    Users are orders, hours are source versions and ``event_id % 4`` is the snapshot, so
    versions repeat and clash across snapshots.
    """
    events = table(spark, folder, "events")
    payload = F.concat_ws("|", "user_id", "event_type", F.col("value").cast("decimal(18,2)"))
    lines = F.expr(
        "transform(sequence(1, 1 + cast(event_id % 3 as int)), j -> struct("
        "concat_ws('-', user_id, j) as line_id, concat('Item ', j) as product_name, "
        "case when j <> 3 then concat('SKU-', j) end as sku, j as quantity, "
        "cast(value as decimal(18,2)) as unit_amount, "
        "cast(cast(value as decimal(18,2)) * j as decimal(18,2)) as line_amount))"
    )
    return events.select(
        F.concat(F.lit("s"), F.col("event_id") % 4).alias("snapshot_id"),
        F.col("user_id").cast("string").alias("order_id"),
        F.concat(F.lit("#"), F.col("user_id")).alias("order_number"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, user_id)").alias(
            "created_at"
        ),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("updated_at"),
        F.expr(
            "CASE event_type WHEN 'purchase' THEN 'FULFILLED' WHEN 'view' THEN 'UNCONFIRMED' "
            "WHEN 'click' THEN 'UNFULFILLED' WHEN 'error' THEN 'CANCELED' ELSE 'DRAFT' END"
        ).alias("status"),
        F.concat(F.lit("channel-"), F.col("user_id") % 5).alias("channel"),
        F.expr("CASE user_id % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'PLN' END").alias(
            "currency"
        ),
        F.col("value").cast("decimal(18,2)").alias("total_amount"),
        lines.alias("lines"),
        F.concat_ws("|", payload, F.format_string("%020d", "event_id")).alias("payload_json"),
        F.sha2(payload, 256).alias("payload_hash"),
    )


_GROSS = """'{{"gross":{{"amount":"', {amount}, '","currency":"', {currency}, '"}}}}'"""


def raw_orders(
    spark: SparkSession, folder: str, beside: DataFrame | None = None
) -> DataFrame:
    """Raw JSON, one document per row of ``orders``, with seeded faults.

    ``beside`` adds its columns by ``line_key``; it is joined before the documents are made, so
    that a filter on it spares the others.

    Documents carry one to three lines as a plain list, as ``edges`` or as ``nodes``.
    Faults follow from the order key alone (see the query oracles), so what the contract
    must say about each row is known without reading JSON.
    """
    key = "o_orderkey"
    unit = f"cast((({key} * 31 + j * 17) % 100000 + 100) / 100 as decimal(18,2))"
    quantity = f"(({key} + j) % 9 + 1)"
    line_currency = f"if(j = 1 and {key} % 79 = 0, 'XXX', currency)"
    shown_quantity = (
        f"case when j = 1 and {key} % 97 = 0 then '0' when j = 1 and {key} % 89 = 0 then 'true' "
        f"else cast({quantity} as string) end"
    )
    sku = f"if(({key} + j) % 50 = 0, 'null', concat('\"SKU-', ({key} * 7 + j) % 200, '\"'))"
    gross_unit = _GROSS.format(amount=unit, currency=line_currency)
    gross_line = _GROSS.format(
        amount=f"cast({unit} * {quantity} as decimal(18,2))", currency="currency"
    )
    line = (
        f"""concat('{{"id":"', {key}, '-', 4 - j, '","productName":" Item ', """
        f"""({key} * 7 + j) % 200, ' ","productSku":', {sku}, ',"quantity":', {shown_quantity}, """
        f"""',"unitPrice":', {gross_unit}, ',"totalPrice":', {gross_line}, '}}')"""
    )
    plain = f"transform(sequence(1, 1 + cast({key} % 3 as int)), j -> {line})"
    nodes = f"""transform({plain}, x -> concat('{{"node":', x, '}}'))"""
    lines = (
        f"case when {key} % 53 = 0 then '[]' "
        f"when {key} % 5 = 1 then concat('{{\"edges\":[', array_join({nodes}, ','), ']}}') "
        f"when {key} % 5 = 2 then concat('{{\"nodes\":[', array_join({plain}, ','), ']}}') "
        f"else concat('[', array_join({plain}, ','), ']') end"
    )
    updated = (
        f"o_orderdate + make_dt_interval(0, if({key} % 47 = 0, -1, cast({key} % 48 as int)))"
    )
    zone = f"if({key} % 83 = 0, '', '+00:00')"
    channel = (
        f"if({key} % 59 = 0, '', concat('\"channel\":{{\"slug\":\"', channel, "
        "'\",\"currencyCode\":\"', lower(currency), '\"},'))"
    )
    total = _GROSS.format(
        amount=f"if({key} % 61 = 0, 'NaN', cast(cast(o_totalprice as decimal(18,2)) as string))",
        currency="currency",
    )
    status = (
        f"case when {key} % 67 = 0 then 'LOST' when {key} % 7 = 0 then 'DRAFT' "
        "when o_orderstatus = 'F' then 'FULFILLED' when o_orderstatus = 'O' then 'UNFULFILLED' "
        "else 'CANCELED' end"
    )
    document = (
        f"""concat('{{"id":"', if({key} % 73 = 0, '  ', cast({key} as string)), """
        f"""'","number":"#', {key}, '","created":"', replace(cast(o_orderdate as string), ' ', 'T'), """
        f"""'Z","updatedAt":"', replace(cast({updated} as string), ' ', 'T'), {zone}, '","status":"', """
        f"""{status}, '",', {channel}, '"total":', {total}, ',"lines":', {lines}, ',"extra":1}}')"""
    )
    text = F.expr(document)
    cut = F.expr(f"{key} % 71 = 0")
    base = _orders_with_customer(spark, folder, spread_by="o_orderkey")
    added = []
    if beside is not None:
        added = [name for name in beside.columns if name != "line_key"]
        base = base.join(beside.withColumnRenamed("line_key", key), key)
    return (
        base
        .withColumn("raw", text)
        .select(
            F.lit("orders").alias("source_file"),
            (F.col(key) + 1).alias("line_number"),
            F.col(key).alias("line_key"),
            F.when(cut, F.expr("substr(raw, 1, length(raw) - 2)")).otherwise(F.col("raw")).alias(
                "raw"
            ),
            *added,
        )
    )


def raw_event_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Raw JSON, one document per row of ``events``; source versions are user days.

    Several events of a user day carry the same version: equal ones are duplicates and
    different ones conflicts. An unknown status makes signups invalid.
    """
    status = (
        "CASE event_type WHEN 'purchase' THEN 'FULFILLED' WHEN 'view' THEN 'UNCONFIRMED' "
        "WHEN 'click' THEN 'UNFULFILLED' WHEN 'error' THEN 'CANCELED' ELSE 'SIGNED' END"
    )
    gross = '{"gross":{"amount":20,"currency":"USD"}}'
    document = F.format_string(
        '{"id":"%d","number":"#%d","created":"2024-01-01T00:00:00Z","updatedAt":"%sT00:00:00Z",'
        '"status":"%s","channel":{"slug":"web","currencyCode":"USD"},"total":' + gross + ","
        '"lines":[{"id":"%d-1","productName":"Item","quantity":1,"unitPrice":' + gross + ","
        '"totalPrice":' + gross + "}]}",
        "user_id",
        "user_id",
        F.to_date("ts").cast("string"),
        F.expr(status),
        "user_id",
    )
    return spread(table(spark, folder, "events"), "event_id").select(
        F.lit("events").alias("source_file"),
        (F.col("event_id") + 1).alias("line_number"),
        F.col("event_id").alias("line_key"),
        document.alias("raw"),
    )
