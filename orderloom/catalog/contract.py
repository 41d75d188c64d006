"""Contract checks and in-batch classification over raw documents."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import functions as F

from orderloom.catalog import views
from orderloom.catalog.views import with_views
from orderloom.functions import hashing, json_values
from orderloom.operators import contract, dedup
from orderloom.schemas import LINE
from orderloom.session import materialize
from orderloom.sources import star_tables as star

_ORDER_COLUMNS = (
    "order_id",
    "order_number",
    "created_at",
    "updated_at",
    "status",
    "channel",
    "currency",
    "total_amount",
)


def _accepted(spark, folder):
    return contract.judge(star.raw_orders(spark, folder)).filter(F.col("error").isNull())


def contract_accepted_orders(spark, folder):
    return _accepted(spark, folder).select(*_ORDER_COLUMNS, F.size("lines").alias("n_lines"))


def contract_accepted_lines(spark, folder):
    return _accepted(spark, folder).select("order_id", F.inline("lines"))


def contract_reject_reasons(spark, folder):
    judged = contract.judge(star.raw_orders(spark, folder))
    return judged.filter(F.col("error").isNotNull()).select("line_number", "error")


# One edit of a valid document for each message, and the message.
_PRICE = '{"gross":{"amount":"1.00","currency":"USD"}}'
_DOCUMENT = (
    '{"id":"KEY","number":"#KEY","created":"2024-01-02T03:04:05Z","updatedAt":"2024-01-02T04:00:00Z",'
    '"status":"FULFILLED","channel":{"slug":"web","currencyCode":"USD"},"total":' + _PRICE + ',"lines":['
    '{"id":"1","productName":"Pen","productSku":"P","quantity":2,"unitPrice":' + _PRICE
    + ',"totalPrice":' + _PRICE + '},'
    '{"id":"2","productName":"Ink","productSku":null,"quantity":1,"unitPrice":' + _PRICE
    + ',"totalPrice":' + _PRICE + "}]}"
)
_LINES = _DOCUMENT[_DOCUMENT.index('"lines":') :]
_FAULTS = (
    ('{"id"', '{id"', "record must be valid JSON"),
    (_DOCUMENT, "[1]", "record must be a JSON object"),
    ('{"slug":"web","currencyCode":"USD"}', '"web"', "channel must be an object"),
    (',"currencyCode":"USD"', "", "channel.currencyCode is required"),
    ('Code":"USD"', 'Code":"US1"', "channel.currencyCode must be a three-letter currency"),
    ('Code":"USD"', 'Code":"GBP"', "currency must be USD, EUR or PLN"),
    (_LINES, '"lines":{"edges":"x"}}', "line connection must contain a list"),
    (_LINES, '"lines":{"edges":[1]}}', "line must be an object"),
    (_LINES, '"lines":[]}', "lines must contain at least one line"),
    (_LINES, '"lines":[1]}', "lines[0] must be an object"),
    ('"id":"1"', '"id":" "', "lines[0].id must be a nonempty string"),
    ('"id":"2"', '"id":" 1 "', "line IDs must be unique strings"),
    ('"quantity":2', '"quantity":2.0', "lines[0].quantity must be a positive integer"),
    ('"Ink"', "null", "lines[1].productName must be a nonempty string"),
    ('"productSku":"P"', '"productSku":""', "sku must be a nonempty string"),
    ('"unitPrice":' + _PRICE, '"unitPrice":"x"', "unitPrice must be an object"),
    ('"totalPrice":' + _PRICE, '"totalPrice":1', "totalPrice must be an object"),
    ('"unitPrice":' + _PRICE, '"unitPrice":{"gross":"x"}', "lines[0].unitPrice.gross must be a money object"),
    (
        '"unitPrice":' + _PRICE,
        '"unitPrice":{"gross":{"amount":1,"currency":"EUR"}}',
        "lines[0].unitPrice.gross currency must match order currency",
    ),
    (
        '"unitPrice":' + _PRICE,
        '"unitPrice":{"gross":{"amount":"abc","currency":"USD"}}',
        "lines[0].unitPrice.gross.amount must be numeric",
    ),
    ('"totalPrice":' + _PRICE, '"totalPrice":{}', "lines[0].totalPrice.gross must be a money object"),
    (
        '"totalPrice":' + _PRICE,
        '"totalPrice":{"gross":{"amount":1,"currency":"usd"}}',
        "lines[0].totalPrice.gross currency must match order currency",
    ),
    (
        '"totalPrice":' + _PRICE,
        '"totalPrice":{"gross":{"amount":-1,"currency":"USD"}}',
        "lines[0].totalPrice.gross.amount must be numeric",
    ),
    ("2024-01-02T03:04:05Z", "yesterday", "created must be an ISO-8601 timestamp"),
    ("2024-01-02T03:04:05Z", "2024-01-02T03:04:05", "created must include a timezone"),
    ("2024-01-02T04:00:00Z", "2024-13-02T04:00:00Z", "updatedAt must be an ISO-8601 timestamp"),
    ("2024-01-02T04:00:00Z", "2024-01-02", "updatedAt must include a timezone"),
    ("2024-01-02T04:00:00Z", "2024-01-02T04:00:00+09:00", "updatedAt must not precede created"),
    ('"status":"FULFILLED"', '"status":" "', "status must be a nonempty string"),
    ('"status":"FULFILLED"', '"status":"fulfilled"', "unsupported order status"),
    ('"id":"KEY"', '"id":7', "id must be a nonempty string"),
    ('"number":"#KEY"', '"number":null', "number must be a nonempty string"),
    ('"slug":"web"', '"slug":""', "channel.slug must be a nonempty string"),
    ('"total":' + _PRICE, '"total":5', "total must be an object"),
    ('"total":' + _PRICE, '"total":{"gross":[]}', "total.gross must be a money object"),
    (
        '"total":' + _PRICE,
        '"total":{"gross":{"amount":1,"currency":"PLN"}}',
        "total.gross currency must match order currency",
    ),
    (
        '"total":' + _PRICE,
        '"total":{"gross":{"amount":true,"currency":"USD"}}',
        "total.gross.amount must be numeric",
    ),
)


def _once(text, old, new):
    """The text with the first occurrence replaced."""
    assert old in text, old
    return text.replace(old, new, 1)


def contract_messages(spark, folder):
    """What the contract says about a document for each of its messages, and about a good one."""
    shape = F.lit(_DOCUMENT)
    kind = F.col("o_orderkey") % (len(_FAULTS) + 1)
    for number, (old, new, _) in enumerate(_FAULTS, 1):
        shape = F.when(kind == number, F.lit(_once(_DOCUMENT, old, new))).otherwise(shape)
    documents = star.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("line_number"),
        F.replace(shape, F.lit("KEY"), F.col("o_orderkey").cast("string")).alias("raw"),
    )
    return contract.judge(documents).select("line_number", "error", "order_id")


def _filled(pattern, *values):
    """The text with each ``%s`` replaced by a value, as ``format_string`` does, in generated code."""
    texts = [F.coalesce(value.cast("string"), F.lit("null")) for value in values]
    fixed = map(F.lit, pattern.split("%s"))
    return F.concat(next(fixed), *chain.from_iterable(zip(texts, fixed, strict=True)))


def _documents(spark, folder):
    """Raw documents of orders with their own lines, parts by name, and literals in ``extra``.

    Orders without lines and repeated line numbers break the contract as they are; a few statuses,
    currencies and amounts are wrong by key.
    """
    key, price = F.col("o_orderkey"), '{"gross":{"amount":%s,"currency":"USD"}}'
    amount = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    each = (F.col("l_extendedprice") / F.col("l_quantity")).cast("decimal(18,2)").cast("string")
    sku = F.when(F.col("l_partkey") % 50 == 0, "null").otherwise(_filled('"P%s"', F.col("l_partkey")))
    line = _filled(
        '{"id":"%s","productName":"%s","productSku":%s,"quantity":%s,"unitPrice":'
        + price + ',"totalPrice":' + price + "}",
        F.col("l_linenumber"), F.col("p_name"), sku, F.col("l_quantity").cast("int"), each, amount,
    )
    parts = star.table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = (
        star.table(spark, folder, "lineitem")
        .join(parts, "l_partkey")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.array_join(F.collect_list(line), ",").alias("lines"))
    )
    literals = F.array(
        *[F.lit(x) for x in ("NaN", "[-Infinity]", "9" * 1100, '"NaN \\" Infinity"', '{"x":NaN}', "1")]
    )
    total = F.when(key % 17 == 5, "NaN").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    at = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    document = _filled(
        '{"id":"%s","number":"#%s","created":"%s","updatedAt":"%s","status":"%s","channel":{"slug":"%s",'
        '"currencyCode":"usd"},"total":{"gross":{"amount":%s,"currency":"%s"}},"lines":[%s],"extra":%s}',
        key, key, at, at,
        F.when(key % 13 == 4, "shipped").otherwise("FULFILLED"), F.col("o_orderpriority"),
        total, F.when(key % 11 == 3, "EUR").otherwise("USD"),
        F.coalesce("lines", F.lit("")), F.get(literals, (key % 6).cast("int")),
    )
    orders = star.table(spark, folder, "orders").join(lines, "o_orderkey", "left")
    return orders.select(key.alias("line_number"), document.alias("raw"))


def contract_documents(spark, folder):
    """What the contract says about documents of orders, line items and parts."""
    judged = contract.judge(_documents(spark, folder))

    def total(name, kind):
        start = F.lit(0).cast(kind)
        return F.aggregate("lines", start, lambda x, line: (x + line[name]).cast(kind)).alias(name)

    names = F.array_sort(F.col("lines")["product_name"])
    return judged.select(
        "line_number",
        "error",
        "total_amount",
        F.when(F.col("error").isNull(), F.size("lines")).alias("n_lines"),
        total("quantity", "bigint"),
        total("line_amount", "decimal(38,2)"),
        F.size(F.filter("lines", lambda line: line["sku"].isNull())).alias("n_without_sku"),
        F.array_join(names, "|").alias("product_names"),
    )


def sorted_lines(spark, folder):
    """Line IDs of each accepted order in canonical order."""
    ids = F.array_join(F.col("lines")["line_id"], ",").alias("line_ids")
    return _accepted(spark, folder).select("order_id", ids)


def payload_hash(spark, folder):
    """Hash of the canonical text of each order's head."""
    orders = star.orders(spark, folder)
    text = hashing.canonical_json(
        F.col("channel"), F.col("currency"), F.col("order_id"), F.col("status")
    )
    return orders.select("order_id", hashing.payload_hash(text).alias("payload_hash"))


def _classified(spark, folder):
    raw = star.raw_event_orders(spark, folder).withColumn(
        "snapshot_id", F.concat(F.lit("s"), F.col("line_key") % 2)
    )
    # Parsing costs most, and the classification reads the rows twice.
    judged = materialize(contract.judge(raw).drop("raw"), "judged-events")
    return dedup.classify(judged, batch=("snapshot_id",))


def batch_outcomes(spark, folder):
    return _classified(spark, folder).select(
        "snapshot_id", F.col("line_key").alias("event_id"), "outcome"
    )


def snapshot_counts(spark, folder):
    return dedup.snapshot_counts(_classified(spark, folder), "snapshot_id")


def reject_rate_gate(spark, folder):
    counts = snapshot_counts(spark, folder)
    return dedup.gate(counts, limit=0.6).select("snapshot_id", "reject_rate", "quality_gate")


def quarantine_rows(spark, folder):
    """Rejected lines with reason, as the quarantine keeps them."""
    rejected = _classified(spark, folder).filter(F.col("outcome").isin("invalid", "conflict"))
    return rejected.select("snapshot_id", "line_number", "error")


_SHAPES = """
case event_id % 6
  when 0 then concat('{"lines":[', item, ',', item, ']}')
  when 1 then concat('{"lines":{"edges":[{"node":', item, '}]}}')
  when 2 then concat('{"lines":{"edges":[],"nodes":[', item, ',', item, ',', item, ']}}')
  when 3 then concat('{"lines":{"nodes":[{"node":null},', item, ']}}')
  when 4 then '{"lines":{"edges":"x"}}'
  else '{"lines":null}' end"""


def connection_unwrap(spark, folder):
    """Lines per document after unwrapping, and how many are objects."""
    raw_line = "struct<node variant, id variant, quantity variant>"
    documents = star.table(spark, folder, "events").select(
        "event_id",
        F.expr(f"""concat('{{"id":"', user_id, '","quantity":1}}')""").alias("item"),
    )
    parsed = documents.withColumn("raw", F.expr(_SHAPES)).withColumn(
        "document", json_values.parse_line(F.col("raw"))
    )
    document = F.col("document")
    plain = F.try_variant_get(document, "$[0].lines", f"array<{raw_line}>")
    lines = F.coalesce(plain, json_values.connection_lines(document, ".lines", raw_line))
    return parsed.select("event_id", lines.alias("lines")).select(
        "event_id",
        F.size("lines").alias("n_lines"),
        F.size(F.filter("lines", lambda x: x.isNotNull())).alias("n_objects"),
    )


def sku_precedence(spark, folder):
    """The sku that counts when both keys, one or none are present."""
    documents = star.table(spark, folder, "events").withColumn(
        "raw",
        F.expr(
            """case event_id % 4
            when 0 then concat('{"productSku":" P', user_id, '","variantSku":"V"}')
            when 1 then concat('{"variantSku":"V', user_id, '"}')
            when 2 then '{"productSku":null,"variantSku":"V"}' else '{}' end"""
        ),
    )
    document = json_values.parse_line(F.col("raw"))
    sku = json_values.preferred_sku(
        json_values.field(document, ".productSku"), json_values.field(document, ".variantSku")
    )
    return documents.select("event_id", F.btrim(json_values.as_text(sku)).alias("sku"))


def repeated_line_positions(spark, folder):
    """Positions of line IDs already seen earlier in the same order."""
    ids = F.expr(
        "transform(sequence(0, cast(event_id % 7 as int)), "
        "j -> concat(user_id, '-', j % (1 + event_id % 3)))"
    )
    events = star.table(spark, folder, "events").select("event_id", ids.alias("ids"))
    positions = F.inline(
        F.transform(contract.repeated_positions(F.col("ids")), lambda i: F.struct(i.alias("i")))
    )
    return events.select("event_id", positions).select(
        "event_id", F.col("i").cast("int").alias("position")
    )


def line_sort_stability(spark, folder):
    """The sorted lines of each version, which arrive in reverse."""
    versions = star.order_versions(spark, folder).withColumn(
        "lines", F.sort_array(F.reverse(F.col("lines").cast(f"array<{LINE}>")))
    )
    ids = F.transform("lines", lambda x: F.concat_ws(":", x["line_id"], x["quantity"], x["sku"]))
    return versions.select(
        "snapshot_id", "order_id", "updated_at", "payload_hash",
        F.array_join(ids, ",").alias("sorted_lines"),
    )


QUERIES = {
    "contract_accepted_orders": contract_accepted_orders,
    "contract_accepted_lines": contract_accepted_lines,
    "contract_reject_reasons": contract_reject_reasons,
    "contract_messages": contract_messages,
    "contract_documents": contract_documents,
    "sorted_lines": sorted_lines,
    "line_sort_stability": line_sort_stability,
    "payload_hash": payload_hash,
    "batch_outcomes": batch_outcomes,
    "snapshot_counts": snapshot_counts,
    "reject_rate_gate": reject_rate_gate,
    "quarantine_rows": quarantine_rows,
    "connection_unwrap": connection_unwrap,
    "sku_precedence": sku_precedence,
    "repeated_line_positions": repeated_line_positions,
}

SQL = {
    "contract_accepted_orders": with_views(
        views.RAW_ORDERS,
        """
        SELECT order_id, '#' || order_id AS order_number, created_at, updated_at, status, channel,
          currency, total_amount, CAST(1 + k % 3 AS INTEGER) AS n_lines FROM raw_v WHERE error IS NULL""",
    ),
    "contract_accepted_lines": with_views(views.RAW_ORDERS, "SELECT * FROM raw_lines_v"),
    "contract_reject_reasons": with_views(
        views.RAW_ORDERS, "SELECT k + 1 AS line_number, error FROM raw_v WHERE error IS NOT NULL"
    ),
    "contract_messages": f"""
        SELECT o_orderkey AS line_number,
          CASE o_orderkey % {len(_FAULTS) + 1} {" ".join(
              f"WHEN {number} THEN '{message}'" for number, (_, _, message) in enumerate(_FAULTS, 1)
          )} END AS error,
          CASE WHEN o_orderkey % {len(_FAULTS) + 1} = 0 THEN CAST(o_orderkey AS VARCHAR) END AS order_id
        FROM orders""",
    "contract_documents": """
        WITH lines_v AS (
          SELECT l_orderkey, count(*) AS n, count(DISTINCT l_linenumber) AS ids,
            CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS quantity,
            CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS line_amount,
            count(*) FILTER (l_partkey % 50 = 0) AS without_sku,
            string_agg(p_name, '|' ORDER BY p_name) AS names
          FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
        judged_v AS (
          SELECT *, CASE WHEN n IS NULL THEN 'lines must contain at least one line'
            WHEN ids < n THEN 'line IDs must be unique strings'
            WHEN o_orderkey % 13 = 4 THEN 'unsupported order status'
            WHEN o_orderkey % 11 = 3 THEN 'total.gross currency must match order currency'
            WHEN o_orderkey % 17 = 5 THEN 'total.gross.amount must be numeric' END AS error
          FROM orders LEFT JOIN lines_v ON l_orderkey = o_orderkey)
        SELECT o_orderkey AS line_number, error,
          CASE WHEN error IS NULL THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS total_amount,
          CASE WHEN error IS NULL THEN CAST(n AS INTEGER) END AS n_lines,
          CASE WHEN error IS NULL THEN quantity END AS quantity,
          CASE WHEN error IS NULL THEN line_amount END AS line_amount,
          CASE WHEN error IS NULL THEN CAST(without_sku AS INTEGER) END AS n_without_sku,
          CASE WHEN error IS NULL THEN names END AS product_names
        FROM judged_v""",
    "sorted_lines": with_views(
        views.RAW_ORDERS,
        """
        SELECT order_id, string_agg(line_id, ',' ORDER BY line_id) AS line_ids
        FROM raw_lines_v GROUP BY 1""",
    ),
    "line_sort_stability": with_views(
        views.VERSION_LINES,
        """
        SELECT v.snapshot_id, v.order_id, v.updated_at, v.payload_hash,
          string_agg(concat_ws(':', line_id, quantity, sku), ',' ORDER BY line_id) AS sorted_lines
        FROM versions_v v JOIN version_lines_v l ON v.event_id = l.event_id
        GROUP BY v.event_id, 1, 2, 3, 4""",
    ),
    "payload_hash": with_views(
        views.ORDERS,
        """
        SELECT order_id, sha256('{"channel":"' || channel || '","currency":"' || currency
          || '","order_id":"' || order_id || '","status":"' || status || '"}') AS payload_hash
        FROM orders_v""",
    ),
    "batch_outcomes": with_views(
        views.OUTCOMES, "SELECT snapshot_id, event_id, outcome FROM outcomes_v"
    ),
    "snapshot_counts": with_views(views.OUTCOMES, "SELECT * FROM counts_v"),
    "reject_rate_gate": with_views(
        views.OUTCOMES,
        """
        SELECT snapshot_id, reject_rate, CASE WHEN reject_rate <= 0.6 AND conflict_count = 0
          THEN 'passed' ELSE 'failed' END AS quality_gate FROM counts_v""",
    ),
    "quarantine_rows": with_views(
        views.OUTCOMES,
        """
        SELECT snapshot_id, event_id + 1 AS line_number, CASE outcome WHEN 'invalid'
          THEN 'unsupported order status'
          ELSE 'Conflicting payload for the same order and source version' END AS error
        FROM outcomes_v WHERE outcome IN ('invalid', 'conflict')""",
    ),
    "connection_unwrap": """
        SELECT event_id,
          CAST(CASE event_id % 6 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 3 WHEN 3 THEN 2 END
            AS INTEGER) AS n_lines,
          CAST(CASE event_id % 6 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 3 WHEN 3 THEN 1 END
            AS INTEGER) AS n_objects
        FROM events""",
    "sku_precedence": """
        SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'P' || user_id WHEN 1 THEN 'V' || user_id
          END AS sku FROM events""",
    "repeated_line_positions": """
        SELECT event_id, CAST(j AS INTEGER) AS position
        FROM events, (VALUES (1), (2), (3), (4), (5), (6)) AS n(j)
        WHERE j <= event_id % 7 AND j > event_id % 3""",
}
