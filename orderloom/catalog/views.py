"""SQL forms of the views in ``sources.star_tables``, as common table expressions."""

from __future__ import annotations

ORDERS = """
orders_v AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, c_mktsegment AS channel,
    CASE c_nationkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'PLN' END AS currency,
    CASE WHEN o_orderkey % 7 = 0 THEN 'DRAFT' WHEN o_orderstatus = 'F' THEN 'FULFILLED'
         WHEN o_orderstatus = 'O' THEN 'UNFULFILLED' ELSE 'CANCELED' END AS status,
    o_orderdate AS created_at, o_orderdate + to_hours(o_orderkey % 48) AS updated_at,
    CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

LINES = """
lines_v AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
    concat_ws('-', l_orderkey, l_linenumber) AS line_id, p_name AS product_name,
    CASE WHEN l_partkey % 50 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS sku,
    CAST(l_quantity AS INTEGER) AS quantity, CAST(p_retailprice AS DECIMAL(18,2)) AS unit_amount,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS line_amount
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

VERSIONS = """
versions_v AS (
  SELECT event_id, 's' || (event_id % 4) AS snapshot_id, CAST(user_id AS VARCHAR) AS order_id,
    TIMESTAMP '2024-01-01' + to_hours(user_id) AS created_at,
    CAST(date_trunc('hour', ts) AS TIMESTAMP) AS updated_at,
    CASE event_type WHEN 'purchase' THEN 'FULFILLED' WHEN 'view' THEN 'UNCONFIRMED'
      WHEN 'click' THEN 'UNFULFILLED' WHEN 'error' THEN 'CANCELED' ELSE 'DRAFT' END AS status,
    'channel-' || (user_id % 5) AS channel,
    CASE user_id % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'PLN' END AS currency,
    CAST(value AS DECIMAL(18,2)) AS total_amount,
    concat_ws('|', user_id, event_type, CAST(value AS DECIMAL(18,2))) AS payload,
    sha256(concat_ws('|', user_id, event_type, CAST(value AS DECIMAL(18,2)))) AS payload_hash
  FROM events)"""

VERSION_LINES = f"""{VERSIONS},
version_lines_v AS (
  SELECT v.event_id, order_id, snapshot_id, payload_hash,
    order_id || '-' || j AS line_id, 'Item ' || j AS product_name,
    CASE WHEN j <> 3 THEN 'SKU-' || j END AS sku, CAST(j AS INTEGER) AS quantity,
    total_amount AS unit_amount, CAST(total_amount * j AS DECIMAL(18,2)) AS line_amount
  FROM versions_v v, (VALUES (1), (2), (3)) AS n(j)
  WHERE j <= 1 + v.event_id % 3)"""

CURRENT = f"""{VERSION_LINES},
current_v AS (
  SELECT * FROM versions_v
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC, snapshot_id DESC,
    payload DESC, event_id DESC) = 1),
current_lines_v AS (
  SELECT l.* FROM version_lines_v l JOIN current_v c
    ON l.order_id = c.order_id AND l.snapshot_id = c.snapshot_id
    AND l.payload_hash = c.payload_hash)"""

DAILY = f"""{ORDERS},
daily_v AS (
  SELECT CAST(created_at AS DATE) AS order_date, channel, currency, count(*) AS order_count,
    CAST(sum(total_amount) AS DECIMAL(38,2)) AS gross_amount,
    CAST(sum(total_amount) AS DOUBLE) / count(*) AS average_order_value
  FROM orders_v WHERE status NOT IN ('CANCELED', 'DRAFT') GROUP BY 1, 2, 3)"""

PRODUCTS = f"""{DAILY}, {LINES},
products_v AS (
  SELECT CAST(created_at AS DATE) AS order_date, channel, currency, sku, product_name,
    CAST(sum(quantity) AS BIGINT) AS units_ordered,
    CAST(sum(line_amount) AS DECIMAL(38,2)) AS gross_amount
  FROM lines_v JOIN orders_v USING (order_id)
  WHERE status NOT IN ('CANCELED', 'DRAFT') GROUP BY 1, 2, 3, 4, 5)"""

# What the contract must say about each raw order, from its key alone.
RAW_ORDERS = f"""{ORDERS},
raw_v AS (
  SELECT o_orderkey AS k, v.*,
    CASE WHEN k % 71 = 0 THEN 'record must be valid JSON'
      WHEN k % 59 = 0 THEN 'channel.currencyCode is required'
      WHEN k % 53 = 0 THEN 'lines must contain at least one line'
      WHEN k % 97 = 0 OR k % 89 = 0 THEN 'lines[0].quantity must be a positive integer'
      WHEN k % 79 = 0 THEN 'lines[0].unitPrice.gross currency must match order currency'
      WHEN k % 83 = 0 THEN 'updatedAt must include a timezone'
      WHEN k % 47 = 0 THEN 'updatedAt must not precede created'
      WHEN k % 67 = 0 THEN 'unsupported order status'
      WHEN k % 73 = 0 THEN 'id must be a nonempty string'
      WHEN k % 61 = 0 THEN 'total.gross.amount must be numeric' END AS error
  FROM orders JOIN orders_v v ON v.order_id = CAST(o_orderkey AS VARCHAR)),
raw_lines_v AS (
  SELECT order_id, order_id || '-' || (4 - j) AS line_id, 'Item ' || ((k * 7 + j) % 200) AS product_name,
    CASE WHEN (k + j) % 50 <> 0 THEN 'SKU-' || ((k * 7 + j) % 200) END AS sku,
    CAST((k + j) % 9 + 1 AS INTEGER) AS quantity,
    CAST(((k * 31 + j * 17) % 100000 + 100) / 100.0 AS DECIMAL(18,2)) AS unit_amount,
    CAST(CAST(((k * 31 + j * 17) % 100000 + 100) / 100.0 AS DECIMAL(18,2)) * ((k + j) % 9 + 1)
      AS DECIMAL(18,2)) AS line_amount
  FROM raw_v, (VALUES (1), (2), (3)) AS n(j) WHERE error IS NULL AND j <= 1 + k % 3)"""

# Outcome of each raw event order inside its snapshot.
OUTCOMES = """
keyed_v AS (
  SELECT event_id, 's' || (event_id % 2) AS snapshot_id, user_id, CAST(ts AS DATE) AS day,
    event_type, event_type = 'signup' AS bad
  FROM events),
firsts_v AS (
  SELECT *, first_value(event_type) OVER w AS first_type, row_number() OVER w AS rn
  FROM keyed_v WHERE NOT bad
  WINDOW w AS (PARTITION BY snapshot_id, user_id, day ORDER BY event_id)),
outcomes_v AS (
  SELECT event_id, snapshot_id, CASE WHEN rn = 1 THEN 'accepted'
    WHEN event_type = first_type THEN 'duplicate' ELSE 'conflict' END AS outcome FROM firsts_v
  UNION ALL SELECT event_id, snapshot_id, 'invalid' FROM keyed_v WHERE bad),
counts_v AS (
  SELECT snapshot_id, count(*) AS input_count, count(*) FILTER (outcome = 'accepted') AS accepted_count,
    count(*) FILTER (outcome IN ('invalid', 'conflict')) AS rejected_count,
    count(*) FILTER (outcome = 'duplicate') AS duplicate_count,
    count(*) FILTER (outcome = 'conflict') AS conflict_count,
    CAST(count(*) FILTER (outcome IN ('invalid', 'conflict')) AS DOUBLE) / count(*) AS reject_rate
  FROM outcomes_v GROUP BY 1)"""

# One inventory row per user, as if each user's events were one snapshot.
INVENTORY = """
inventory_v AS (
  SELECT 'u' || user_id AS snapshot_id,
    strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS extracted_at,
    count(*) AS accepted_count, count(*) FILTER (event_type = 'error') AS rejected_count,
    count(*) FILTER (event_type = 'view') AS duplicate_count,
    'source-' || (user_id % 7) AS source,
    CASE user_id % 3 WHEN 0 THEN 'full' WHEN 1 THEN 'incremental' ELSE 'backfill' END AS mode,
    strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS upper,
    sha256(concat_ws('|', count(*), max(event_id))) AS manifest_fingerprint
  FROM events GROUP BY user_id),
prior_v AS (
  SELECT 'u' || user_id AS snapshot_id,
    sha256(concat_ws('|', count(*), max(event_id))) AS manifest_fingerprint
  FROM events WHERE event_type <> 'error' OR value <= 100 GROUP BY user_id)"""


def with_views(views: str, query: str) -> str:
    return f"WITH {views.strip()}\n{query.strip()}"
