"""Field-level rules over values derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.functions import json_values, money, text, timestamps
from orderloom.sources import star_tables as star


def money_normalise(spark, folder):
    """Amount texts in many forms to two decimals, half-even."""
    form = F.expr(
        """case event_id % 10
        when 0 then v when 1 then concat(' ', v, '\t') when 2 then concat('1_0', v)
        when 3 then concat(v, 'e1') when 4 then concat(v, '5') when 5 then 'NaN'
        when 6 then concat('-', v) when 7 then concat(v, '50000000000000000000000001')
        when 8 then concat('+', v, '4999') else '1000000000000000' end"""
    )
    events = star.table(spark, folder, "events").select(
        "event_id", F.lpad(F.col("value").cast("decimal(18,2)").cast("string"), 6, "0").alias("v")
    )
    return events.select("event_id", money.amount_text(form).alias("amount"))


def money_json(spark, folder):
    """Amounts as JSON numbers, texts and values of other types."""
    form = F.expr(
        """case event_id % 6
        when 0 then v when 1 then concat('"', v, '"') when 2 then cast(event_id as string)
        when 3 then 'true' when 4 then 'null' else concat('[', v, ']') end"""
    )
    events = star.table(spark, folder, "events").select(
        "event_id", F.col("value").cast("decimal(18,2)").cast("string").alias("v")
    )
    return events.select("event_id", money.amount(F.try_parse_json(form)).alias("amount"))


def timestamp_normalise(spark, folder):
    """ISO texts in many forms to UTC; those without a zone are flagged."""
    events = star.table(spark, folder, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("iso"),
        F.date_format(F.expr("ts + interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("cet"),
        F.date_format("ts", "yyyyMMdd'T'HHmmss.SSSSSS").alias("basic"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )
    form = F.expr(
        """case event_id % 8
        when 0 then concat(iso, 'Z') when 1 then concat(cet, '+02:00')
        when 2 then concat(basic, 'Z') when 3 then iso when 4 then day
        when 5 then concat(replace(replace(iso, '.', ','), 'T', ' '), '9-00:00')
        when 6 then concat(day, 'T07Z') else concat(day, 'T25:00:00Z') end"""
    )
    moment = timestamps.utc_timestamp(F.col("form"))
    return events.select("event_id", form.alias("form")).select(
        "event_id",
        moment.alias("utc_at"),
        timestamps.canonical_text(moment).alias("utc_text"),
        timestamps.lacks_zone(F.col("form")).alias("lacks_zone"),
    )


def strict_utc_bounds(spark, folder):
    """Texts that name offset zero, as window bounds must."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    zone = F.expr("element_at(array('Z', '+00:00', '-00:00', '+08:00', ''), 1 + cast(event_id % 5 as int))")
    form = F.concat(iso, zone)
    return star.table(spark, folder, "events").select(
        "event_id", timestamps.is_utc(form).alias("is_utc")
    )


def text_trim(spark, folder):
    """Whole texts between Unicode blanks, trimmed."""
    wrapped = F.concat(F.lit("\u3000\t\u00a0"), F.col("text"), F.lit("\u2028\n\u001c"))
    trimmed = text.trim_blanks(wrapped)
    return star.table(spark, folder, "documents").select(
        "doc_id",
        F.length(trimmed).cast("bigint").alias("n_chars"),
        F.sha2(trimmed, 256).alias("digest"),
        text.is_blank(trimmed).alias("is_blank"),
    )


def strict_integer(spark, folder):
    """Quantities that are true JSON integers in range."""
    form = F.expr(
        """case event_id % 8
        when 0 then cast(user_id + 1 as string) when 1 then 'true' when 2 then '2.0'
        when 3 then '"2"' when 4 then '0' when 5 then '2147483648' when 6 then '2147483647'
        else '-1' end"""
    )
    return star.table(spark, folder, "events").select(
        "event_id", json_values.positive_quantity(F.try_parse_json(form)).alias("quantity")
    )


def currency_normalise(spark, folder):
    """Currency codes in any case; other codes and shapes become null."""
    form = F.expr(
        """case pmod(c_custkey, 7)
        when 0 then 'usd' when 1 then 'Eur' when 2 then 'PLN' when 3 then ' USD'
        when 4 then 'GBP' when 5 then 'US' else 'U$D' end"""
    )
    return star.table(spark, folder, "customer").select(
        "c_custkey",
        money.currency(form).alias("currency"),
        money.is_currency_shape(form).alias("is_code"),
    )


def identifier_check(spark, folder):
    """Which texts are valid snapshot and release IDs."""
    form = F.expr(
        """case p_partkey % 4 when 0 then replace(p_name, ' ', '-')
        when 1 then p_name when 2 then concat('-', p_partkey) else repeat('x', 70 + p_size) end"""
    )
    return star.table(spark, folder, "part").select(
        "p_partkey", text.is_identifier(form).alias("is_identifier")
    )


QUERIES = {
    "money_normalise": money_normalise,
    "money_json": money_json,
    "timestamp_normalise": timestamp_normalise,
    "strict_utc_bounds": strict_utc_bounds,
    "text_trim": text_trim,
    "strict_integer": strict_integer,
    "currency_normalise": currency_normalise,
    "identifier_check": identifier_check,
}

SQL = {
    "money_normalise": """
        WITH cents_v AS (
          SELECT event_id, CAST(round(value * 100) AS BIGINT) AS c FROM events)
        SELECT event_id, CAST(CASE event_id % 10 WHEN 0 THEN c WHEN 1 THEN c
          WHEN 2 THEN c + 1000000 WHEN 3 THEN c * 10 WHEN 4 THEN c + c % 2
          WHEN 7 THEN c + 1 WHEN 8 THEN c END / 100.0 AS DECIMAL(18,2)) AS amount
        FROM cents_v""",
    "money_json": """
        SELECT event_id, CASE event_id % 6 WHEN 0 THEN CAST(value AS DECIMAL(18,2))
          WHEN 1 THEN CAST(value AS DECIMAL(18,2))
          WHEN 2 THEN CAST(event_id AS DECIMAL(18,2)) END AS amount FROM events""",
    "timestamp_normalise": """
        WITH utc_v AS (
          SELECT event_id, CASE WHEN event_id % 8 IN (0, 1, 2, 5) THEN ts
            WHEN event_id % 8 = 6 THEN CAST(ts AS DATE) + INTERVAL 7 HOUR END AS utc_at,
            event_id % 8 IN (3, 4) AS lacks_zone FROM events)
        SELECT event_id, utc_at, CASE WHEN microsecond(utc_at) % 1000000 = 0
          THEN strftime(utc_at, '%Y-%m-%dT%H:%M:%SZ')
          ELSE strftime(utc_at, '%Y-%m-%dT%H:%M:%S.%fZ') END AS utc_text, lacks_zone FROM utc_v""",
    "strict_utc_bounds": "SELECT event_id, event_id % 5 < 3 AS is_utc FROM events",
    "text_trim": """
        WITH trimmed_v AS (
          SELECT doc_id, trim(text, (SELECT string_agg(chr(c), '') FROM (VALUES (9), (10), (11),
            (12), (13), (28), (29), (30), (31), (32), (133), (160), (5760), (8192), (8193), (8194),
            (8195), (8196), (8197), (8198), (8199), (8200), (8201), (8202), (8232), (8233), (8239),
            (8287), (12288)) AS b(c))) AS t FROM documents)
        SELECT doc_id, length(t) AS n_chars, sha256(t) AS digest, t = '' AS is_blank
        FROM trimmed_v""",
    "strict_integer": """
        SELECT event_id, CAST(CASE event_id % 8 WHEN 0 THEN user_id + 1 WHEN 6 THEN 2147483647 END
          AS INTEGER) AS quantity FROM events""",
    "currency_normalise": """
        SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'PLN'
          END AS currency, c_custkey % 7 IN (0, 1, 2, 4) AS is_code FROM customer""",
    "identifier_check": """
        SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN true WHEN 1 THEN position(' ' IN p_name) = 0
          WHEN 2 THEN false ELSE p_size <= 10 END AS is_identifier FROM part""",
}
