"""Windows, landed pages, snapshot inventories and release checks."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.catalog import views
from orderloom.catalog.views import with_views
from orderloom.functions import hashing, timestamps
from orderloom.operators import history, lineage, metrics, releases, windows
from orderloom.session import shared_folder
from orderloom.sources import clustered, pages
from orderloom.sources import star_tables as star


def _clock(text="2024-02-01 00:00:00"):
    return F.lit(text).cast("timestamp_ntz")


def _marks(spark, folder):
    """One source per event type; its last event is its mark, and one has none yet."""
    mark = F.when(F.col("event_type") != "signup", F.max("ts"))
    events = star.table(spark, folder, "events").groupBy("event_type").agg(mark.alias("at"))
    return events.select(
        F.col("event_type").alias("source"), timestamps.bound_text(F.col("at")).alias("base_watermark")
    )


def window_full(spark, folder):
    return windows.plan_windows(_marks(spark, folder), "full", _clock())


def window_incremental(spark, folder):
    return windows.plan_windows(_marks(spark, folder), "incremental", _clock("2024-01-30 23:50:00"))


def window_backfill(spark, folder):
    return windows.plan_windows(
        _marks(spark, folder), "backfill", _clock(), "2024-01-05T00:00:00Z", "2024-01-06T00:00:00Z"
    )


def window_read_inclusive(spark, folder):
    window = {
        "mode": "incremental",
        "lower": "2024-01-10T00:00:00+00:00",
        "upper": "2024-01-12T11:59:55+00:00",
    }
    events = star.table(spark, folder, "events").select("event_id", "ts", "user_id")
    return windows.read_window(events, window, "ts")


def window_read_half_open(spark, folder):
    window = {
        "mode": "backfill",
        "lower": "1996-03-01T00:00:00+00:00",
        "upper": "1996-04-01T00:00:00+00:00",
    }
    orders = star.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return windows.read_window(orders, window, "o_orderdate")


_CLUSTERED = {
    "a month": {"mode": "backfill", "lower": "1996-03-01T00:00:00+00:00", "upper": "1996-04-01T00:00:00+00:00"},
    "a day": {"mode": "incremental", "lower": "1995-07-04T00:00:00+00:00", "upper": "1995-07-04T23:59:55+00:00"},
    "a turn of the year": {
        "mode": "backfill", "lower": "1994-12-31T23:55:00+00:00", "upper": "1995-01-02T00:00:00+00:00",
    },
    "all up to 1993": {"mode": "full", "lower": None, "upper": "1993-01-01T00:00:00+00:00"},
}


def clustered_windows(spark, folder):
    """Rows and amounts of windows over orders landed by update month, and how much each reads."""
    orders = star.table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    path = f"{shared_folder(spark).rstrip('/')}/clustered-{uuid.uuid4().hex}"
    clustered.write_clustered(orders, path, "o_orderdate")
    everything = clustered.folders_read(spark.read.parquet(path))
    gross = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)")
    found = []
    for name, window in _CLUSTERED.items():
        rows = clustered.read_clustered(spark, path, orders.schema, window, "o_orderdate")
        found.append(
            rows.agg(
                F.lit(name).alias("window_name"),
                F.count(F.lit(1)).alias("n_records"),
                gross.alias("gross_amount"),
                F.lit(clustered.folders_read(rows)).alias("folders_read"),
                F.lit(everything).alias("folders"),
            )
        )
    return reduce(DataFrame.unionByName, found)


def source_update_order(spark, folder):
    events = star.table(spark, folder, "events").select("event_id", "ts", "user_id")
    return windows.in_update_order(events, "ts", "event_id")


def _pages(spark, folder):
    """One landed page per event; the pages of a user are one extraction."""
    edges = F.expr(
        """array_join(transform(slice(sequence(0, 2), 1, cast(event_id % 4 as int)),
        j -> if(event_id % 53 = 9 and j = 1, '{"cursor":"x"}',
          concat('{"node":{"id":"', event_id, '-', j, '"}}'))), ',')"""
    )
    cursor = F.expr(
        """case when event_id % 50 = 7 then 'null' when event_id % 20 = 3 then '"same"'
        else concat('"c', event_id, '"') end"""
    )
    more = F.expr("if(event_id % 4 = 0, 'false', 'true')")
    page = F.concat(
        F.lit('{"edges":['), edges, F.lit('],"pageInfo":{"hasNextPage":'), more,
        F.lit(',"endCursor":'), cursor, F.lit("}}"),
    )
    wrapped = F.when(
        F.col("event_id") % 2 == 0, F.concat(F.lit('{"orders":'), page, F.lit("}"))
    ).otherwise(page)
    cut_off = F.substring(wrapped, 1, F.length(wrapped) - 1)
    wrapped = F.when(F.col("event_id") % 61 == 5, cut_off).otherwise(wrapped)
    return star.table(spark, folder, "events").select("event_id", "user_id", wrapped.alias("page"))


def page_nodes(spark, folder):
    return pages.nodes(_pages(spark, folder)).drop("user_id")


def _landings(spark, folder):
    """Pages of one extraction per user, in event order, with the faults that ``_LANDINGS`` names."""
    by_user = Window.partitionBy("user_id")
    events = (
        star.table(spark, folder, "events")
        .select("event_id", "user_id")
        .withColumn("n", F.row_number().over(by_user.orderBy("event_id")))
        .withColumn("size", F.count(F.lit(1)).over(by_user))
        .withColumn("before", F.lag("event_id").over(by_user.orderBy("event_id")))
    )
    placed = events.selectExpr("*", "user_id % 12 as fault", "cast(size div 2 as int) as half")
    told = placed.selectExpr(
        "event_id", "user_id", "n",
        """case when fault = 5 and n = half + 1 then null
          when fault = 6 and n = half then 'x' when fault = 6 and n = half + 1 then 'y'
          when fault = 0 and before % 20 = 3 then 'same'
          else concat('c', before) end as after""",
        """case when fault = 6 and n = half - 1 then concat('"c', lead(event_id, 2) over
            (partition by user_id order by event_id), '"')
          when fault = 6 and n = half then '"y"' when fault = 6 and n = half + 1 then '"x"'
          when fault = 0 and event_id % 50 = 7 then 'null' when fault = 0 and event_id % 20 = 3 then '"same"'
          else concat('"c', event_id, '"') end as cursor""",
        "if(n = size or (fault = 5 and n = half), 'false', 'true') as more",
        """case when fault = 2 and n = 1 or fault = 3 and n = half or fault = 4 and n = size then 0
          when fault = 7 and n = half then 2 else 1 end as copies""",
        "fault = 1 and event_id % 61 = 5 as cut_off",
        "if(fault = 1 and event_id % 53 = 9, '{\"cursor\":\"x\"}', concat('{\"node\":{\"id\":\"', event_id, '\"}}')) as edge",
    )
    page = F.format_string(
        '{"edges":[%s],"pageInfo":{"hasNextPage":%s,"endCursor":%s}}', "edge", "more", "cursor"
    )
    wrapped = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"orders":'), page, F.lit("}"))).otherwise(page)
    whole = F.when(F.col("cut_off"), F.substring(wrapped, 1, F.length(wrapped) - 1)).otherwise(wrapped)
    return told.select(
        "event_id", "user_id", "after", whole.alias("page"), F.explode(F.array_repeat(F.lit(1), F.col("copies")))
    ).drop("col")


def page_chain(spark, folder):
    return pages.chain(_landings(spark, folder), "user_id")


def page_order(spark, folder):
    landed = pages.in_order(_landings(spark, folder), "user_id")
    return landed.select("event_id", "user_id", "page_number")


def _inventory(spark, folder):
    """One inventory row per user, as if each user's events were one snapshot."""
    user = F.col("user_id")
    events = star.table(spark, folder, "events")
    rows = events.groupBy("user_id").agg(
        F.max("ts").alias("last"),
        F.max("event_id").alias("last_id"),
        F.count(F.lit(1)).alias("accepted_count"),
        F.count_if(F.col("event_type") == "error").alias("rejected_count"),
        F.count_if(F.col("event_type") == "view").alias("duplicate_count"),
    )
    at = timestamps.bound_text(F.col("last"))
    return rows.select(
        F.concat(F.lit("u"), user).alias("snapshot_id"),
        at.alias("extracted_at"),
        "accepted_count",
        "rejected_count",
        "duplicate_count",
        F.concat(F.lit("source-"), user % 7).alias("source"),
        F.expr("case user_id % 3 when 0 then 'full' when 1 then 'incremental' else 'backfill' end")
        .alias("mode"),
        at.alias("upper"),
        F.sha2(F.concat_ws("|", "accepted_count", "last_id"), 256).alias("manifest_fingerprint"),
    )


def _prior(spark, folder):
    """The same inventory as it was without large error events."""
    rows = (
        star.table(spark, folder, "events")
        .filter((F.col("event_type") != "error") | (F.col("value") <= 100))
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id"))
    )
    return rows.select(
        F.concat(F.lit("u"), "user_id").alias("snapshot_id"),
        F.sha2(F.concat_ws("|", "n", "last_id"), 256).alias("manifest_fingerprint"),
    )


def _exclusions(spark, folder):
    """Snapshots of users with a very large event."""
    large = star.table(spark, folder, "events").filter(F.col("value") > 200)
    return large.select(F.concat(F.lit("u"), "user_id").alias("snapshot_id")).distinct()


def high_water_marks(spark, folder):
    earlier = star.table(spark, folder, "events").filter(F.col("event_type") == "purchase")
    previous = earlier.groupBy(F.concat(F.lit("source-"), F.col("user_id") % 7).alias("source")).agg(
        F.max("ts").alias("last")
    )
    marks = previous.select("source", timestamps.bound_text(F.col("last")).alias("watermark"))
    return releases.high_water_marks(_inventory(spark, folder), marks)


def release_totals(spark, folder):
    return releases.release_totals(_inventory(spark, folder))


def latest_input(spark, folder):
    return releases.latest_input(_inventory(spark, folder)).select("snapshot_id", "extracted_at")


def inventory_signature(spark, folder):
    return releases.inventory_signature(_inventory(spark, folder))


def content_fingerprint(spark, folder):
    """Fingerprint of the event log per snapshot."""
    row = hashing.row_text(F.col("event_id"), F.col("event_type"), F.col("props"))
    events = star.table(spark, folder, "events").select(
        F.concat(F.lit("s"), F.col("event_id") % 4).alias("snapshot_id"), row.alias("row")
    )
    return events.groupBy("snapshot_id").agg(hashing.fingerprint(F.col("row")).alias("fingerprint"))


def history_union(spark, folder):
    versions = star.order_versions(spark, folder)
    return versions.groupBy("snapshot_id").agg(
        F.count(F.lit(1)).alias("versions"),
        F.sum("total_amount").cast("decimal(38,2)").alias("total_amount"),
    )


def approved_history(spark, folder):
    """Versions of passed snapshots that are not excluded."""
    versions = star.order_versions(spark, folder)
    snapshots = versions.groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("n"))
    manifests = snapshots.withColumn(
        "quality_gate", F.when(F.col("snapshot_id") == "s1", "failed").otherwise("passed")
    )
    exclusions = snapshots.filter(F.col("snapshot_id") == "s3")
    return history.approved(versions, manifests, exclusions).select(
        "snapshot_id", "order_id", "updated_at", "payload_hash"
    )


def missing_prior_inputs(spark, folder):
    return releases.missing_prior_inputs(_prior(spark, folder), _inventory(spark, folder))


def excluded_inputs(spark, folder):
    inputs = _inventory(spark, folder).select("snapshot_id", "manifest_fingerprint")
    return releases.excluded_inputs(inputs, _exclusions(spark, folder))


def altered_inputs(spark, folder):
    return releases.altered_inputs(_inventory(spark, folder), _prior(spark, folder))


def publish_guard(spark, folder):
    """How many inputs break each rule of publication."""
    checks = {
        "missing_prior": missing_prior_inputs(spark, folder),
        "excluded": excluded_inputs(spark, folder),
        "altered": altered_inputs(spark, folder),
    }
    rows = [
        df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("rule"), "failures")
        for name, df in checks.items()
    ]
    return reduce(DataFrame.unionByName, rows).withColumn("allowed", F.col("failures") == 0)


def _pointer(spark, folder):
    """A publication at the time of the last purchase."""
    events = star.table(spark, folder, "events").agg(
        F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("at"),
        F.count_if(F.col("event_type") == "error").alias("rejected_count"),
        F.count_if(F.col("event_type") == "view").alias("duplicate_count"),
    )
    return events.select(
        F.lit("r1").alias("release_id"),
        timestamps.bound_text(F.col("at")).alias("published_at"),
        F.lit(10).alias("data_tests_passed"),
        "rejected_count",
        "duplicate_count",
    )


def release_status(spark, folder):
    inputs = _inventory(spark, folder).select(F.lit("r1").alias("release_id"), "extracted_at")
    return releases.status(_pointer(spark, folder), inputs, _clock("2024-01-31 12:00:00"))


def lineage_trace(spark, folder):
    """Raw lines behind the daily groups above a gross threshold."""
    versions = star.order_versions(spark, folder).withColumn(
        "line_key", F.element_at(F.split("payload_json", r"\|"), -1).cast("bigint")
    )
    orders = history.current_orders(versions)
    groups = metrics.daily_order_metrics(orders).filter(F.col("gross_amount") > 10)
    raw = star.raw_event_orders(spark, folder).withColumn(
        "snapshot_id", F.concat(F.lit("s"), F.col("line_key") % 4)
    )
    return lineage.raw_lines_behind(groups, orders, versions, raw).select(
        "order_date", "channel", "currency", "order_id", "snapshot_id", "line_number"
    )


QUERIES = {
    "window_full": window_full,
    "window_incremental": window_incremental,
    "window_backfill": window_backfill,
    "window_read_inclusive": window_read_inclusive,
    "window_read_half_open": window_read_half_open,
    "source_update_order": source_update_order,
    "clustered_windows": clustered_windows,
    "page_nodes": page_nodes,
    "page_chain": page_chain,
    "page_order": page_order,
    "high_water_marks": high_water_marks,
    "release_totals": release_totals,
    "latest_input": latest_input,
    "inventory_signature": inventory_signature,
    "content_fingerprint": content_fingerprint,
    "history_union": history_union,
    "approved_history": approved_history,
    "missing_prior_inputs": missing_prior_inputs,
    "excluded_inputs": excluded_inputs,
    "altered_inputs": altered_inputs,
    "publish_guard": publish_guard,
    "release_status": release_status,
    "lineage_trace": lineage_trace,
}


def _iso(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"


_MARKS = f"""
marks_v AS (
  SELECT event_type AS source, CASE WHEN event_type <> 'signup' THEN max(ts) END AS mark_at,
    CASE WHEN event_type <> 'signup' THEN {_iso('max(ts)')} END AS base_watermark
  FROM events GROUP BY event_type)"""


def _window(mode, upper, lower, problem="CAST(NULL AS VARCHAR)", half_open=False):
    return f"""
        SELECT '{mode}' AS mode, source, '{upper}' AS upper, {lower} AS lower, base_watermark,
          CAST({"'[start, end)'" if half_open else 'NULL'} AS VARCHAR) AS range_semantics,
          CAST({'false' if half_open else 'NULL'} AS BOOLEAN) AS watermark_advance,
          {problem} AS problem FROM marks_v"""


_FINGERPRINT = "concat_ws(':', count(*), {})".format(
    ", ".join(
        f"bit_xor(CAST('0x' || substr(sha256(text_row), {start}, 15) AS BIGINT))"
        for start in (1, 16, 31, 46)
    )
)
_MISSING = """
missing_v AS (SELECT p.* FROM prior_v p ANTI JOIN inventory_v i
  ON p.snapshot_id = i.snapshot_id AND p.manifest_fingerprint = i.manifest_fingerprint),
excluded_v AS (SELECT snapshot_id, manifest_fingerprint FROM inventory_v WHERE snapshot_id IN (
  SELECT 'u' || user_id FROM events WHERE value > 200)),
altered_v AS (SELECT i.snapshot_id, i.manifest_fingerprint FROM inventory_v i
  LEFT JOIN prior_v p ON p.snapshot_id = i.snapshot_id
  WHERE i.manifest_fingerprint IS DISTINCT FROM p.manifest_fingerprint)"""
_CHECKS = f"{views.INVENTORY}, {_MISSING}"

# One extraction per user with one kind of fault: 0 cursors missing or repeated, 1 pages cut off and
# edges without node, 2 the first, 3 a middle, 4 the last page lost, 5 two chains, 6 a chain and a
# loop, 7 a page landed twice. ``walk`` follows the cursors from the first page.
_LANDINGS = """
        events_v AS (
          SELECT event_id, user_id, row_number() OVER w AS n, count(*) OVER (PARTITION BY user_id) AS size,
            lag(event_id) OVER w AS before, lead(event_id, 2) OVER w AS skipped, user_id % 12 AS fault,
            size // 2 AS half FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
        told_v AS (
          SELECT event_id, user_id, fault = 1 AND event_id % 61 = 5 AS cut_off,
            fault = 1 AND event_id % 53 = 9 AND NOT cut_off AS nodeless,
            n <> size AND NOT (fault = 5 AND n = half) AND NOT cut_off AS more,
            CASE WHEN fault = 5 AND n = half + 1 THEN NULL WHEN fault = 6 AND n = half THEN 'x'
              WHEN fault = 6 AND n = half + 1 THEN 'y' WHEN fault = 0 AND before % 20 = 3 THEN 'same'
              ELSE 'c' || before END AS after,
            CASE WHEN NOT more THEN NULL WHEN fault = 6 AND n = half - 1 THEN 'c' || skipped
              WHEN fault = 6 AND n = half THEN 'y' WHEN fault = 6 AND n = half + 1 THEN 'x'
              WHEN fault = 0 AND event_id % 50 = 7 THEN NULL WHEN fault = 0 AND event_id % 20 = 3 THEN 'same'
              ELSE 'c' || event_id END AS cursor,
            CASE WHEN fault = 2 AND n = 1 OR fault = 3 AND n = half OR fault = 4 AND n = size THEN 0
              WHEN fault = 7 AND n = half THEN 2 ELSE 1 END AS copies
          FROM events_v),
        landed_v AS (SELECT t.* FROM told_v t, (VALUES (1), (2)) AS c(copy) WHERE copy <= copies),
        walk(user_id, event_id, cursor, page_number) AS (
          SELECT user_id, event_id, cursor, CAST(1 AS BIGINT) FROM landed_v WHERE after IS NULL
          UNION
          SELECT l.user_id, l.event_id, l.cursor, page_number + 1 FROM walk w JOIN landed_v l
            ON l.user_id = w.user_id AND l.after = w.cursor WHERE page_number < 500)"""

SQL = {
    "window_full": with_views(
        _MARKS, _window("full", "2024-01-31T23:59:55+00:00", "CAST(NULL AS VARCHAR)")
    ),
    "window_incremental": with_views(
        _MARKS,
        _window(
            "incremental",
            "2024-01-30T23:49:55+00:00",
            _iso("(mark_at - INTERVAL 5 MINUTE)"),
            f"CASE WHEN mark_at IS NULL THEN '{windows.NO_MARK}' "
            "WHEN mark_at > TIMESTAMP '2024-01-30 23:49:55' "
            f"THEN '{windows.CLOCK_BEHIND}' END",
        ),
    ),
    "window_backfill": with_views(
        _MARKS,
        _window(
            "backfill", "2024-01-06T00:00:00+00:00", "'2024-01-05T00:00:00+00:00'", half_open=True
        ),
    ),
    "window_read_inclusive": """
        SELECT event_id, ts, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'
          AND ts <= TIMESTAMP '2024-01-12 11:59:55'""",
    "window_read_half_open": """
        SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-03-01'
          AND o_orderdate < TIMESTAMP '1996-04-01'""",
    "clustered_windows": """
        WITH bounds_v(window_name, lower_at, upper_at) AS (VALUES
          ('a month', TIMESTAMP '1996-03-01', TIMESTAMP '1996-03-31 23:59:59.999999'),
          ('a day', TIMESTAMP '1995-07-04', TIMESTAMP '1995-07-04 23:59:55'),
          ('a turn of the year', TIMESTAMP '1994-12-31 23:55:00', TIMESTAMP '1995-01-01 23:59:59.999999'),
          ('all up to 1993', TIMESTAMP '1900-01-01', TIMESTAMP '1993-01-01')),
        months_v AS (
          SELECT date_trunc('month', o_orderdate) AS m FROM orders GROUP BY 1)
        SELECT window_name, (SELECT count(*) FROM orders WHERE o_orderdate BETWEEN lower_at AND upper_at) AS n_records,
          (SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) FROM orders
            WHERE o_orderdate BETWEEN lower_at AND upper_at) AS gross_amount,
          CAST((SELECT count(*) FROM months_v WHERE m BETWEEN date_trunc('month', lower_at) AND upper_at) AS INTEGER)
            AS folders_read,
          CAST((SELECT count(*) FROM months_v) AS INTEGER) AS folders
        FROM bounds_v""",
    "source_update_order": "SELECT event_id, ts, user_id FROM events ORDER BY ts, event_id",
    "page_nodes": """
        SELECT event_id, CAST(j AS INTEGER) AS position, CASE WHEN event_id % 53 <> 9 OR j <> 1
          THEN '{"id":"' || event_id || '-' || j || '"}' END AS raw
        FROM events, (VALUES (0), (1), (2)) AS n(j) WHERE j < event_id % 4 AND event_id % 61 <> 5""",
    "page_chain": f"""
        WITH RECURSIVE {_LANDINGS},
        named_v AS (SELECT user_id, cursor, count(*) AS n FROM landed_v WHERE cursor IS NOT NULL GROUP BY 1, 2),
        asked_v AS (SELECT user_id, after, count(*) AS n FROM landed_v WHERE after IS NOT NULL GROUP BY 1, 2),
        links_v AS (
          SELECT coalesce(a.user_id, c.user_id) AS user_id,
            coalesce(sum(greatest(c.n - 1, 0)), 0) AS repeated_cursors,
            count(*) FILTER (a.n IS NULL) AS lost_pages, count(*) FILTER (c.n IS NULL) AS unnamed_requests,
            coalesce(sum(greatest(a.n - 1, 0)), 0) AS repeated_requests
          FROM named_v c FULL JOIN asked_v a ON a.user_id = c.user_id AND after = cursor GROUP BY 1),
        facts_v AS (
          SELECT user_id, count(*) AS pages, count(*) FILTER (after IS NULL) AS first_pages,
            count(*) FILTER (NOT more AND NOT cut_off) AS final_pages,
            count(*) FILTER (more AND cursor IS NULL) AS missing_cursors,
            CAST(any_value(repeated_cursors) AS BIGINT) AS repeated_cursors,
            any_value(lost_pages) AS lost_pages, any_value(unnamed_requests) AS unnamed_requests,
            CAST(any_value(repeated_requests) AS BIGINT) AS repeated_requests,
            count(*) FILTER (cut_off) AS broken_pages, count(*) FILTER (nodeless) AS missing_nodes
          FROM landed_v LEFT JOIN links_v USING (user_id) GROUP BY 1),
        sound_v AS (
          SELECT *, first_pages = 1 AND final_pages = 1 AND missing_cursors + repeated_cursors + lost_pages
            + unnamed_requests + repeated_requests + broken_pages + missing_nodes = 0 AS sound FROM facts_v)
        SELECT s.* EXCLUDE (sound), CASE WHEN sound THEN reached END AS linked_pages,
          sound AND reached = pages AS complete
        FROM sound_v s LEFT JOIN (SELECT user_id, max(page_number) AS reached FROM walk GROUP BY 1) w
          USING (user_id)""",
    "page_order": f"""
        WITH RECURSIVE {_LANDINGS},
        whole_v AS (
          SELECT user_id FROM landed_v LEFT JOIN walk USING (user_id, event_id) GROUP BY 1
          HAVING count(*) = count(page_number) AND count(*) = count(DISTINCT event_id)
            AND count(DISTINCT page_number) = count(*) AND NOT bool_or(cut_off) AND NOT bool_or(nodeless)
            AND count(*) FILTER (NOT more) = 1)
        SELECT event_id, user_id, page_number FROM landed_v
          LEFT JOIN (SELECT user_id, event_id, page_number FROM walk JOIN whole_v USING (user_id))
          USING (user_id, event_id)""",
    "high_water_marks": with_views(
        views.INVENTORY,
        f"""
        SELECT source, max(watermark) AS watermark FROM (
          SELECT source, upper AS watermark FROM inventory_v WHERE mode IN ('full', 'incremental')
          UNION ALL SELECT 'source-' || (user_id % 7), {_iso('max(ts)')} FROM events
            WHERE event_type = 'purchase' GROUP BY 1) GROUP BY 1""",
    ),
    "release_totals": with_views(
        views.INVENTORY,
        """
        SELECT count(*) AS snapshots, CAST(sum(accepted_count) AS BIGINT) AS accepted_count,
          CAST(sum(rejected_count) AS BIGINT) AS rejected_count,
          CAST(sum(duplicate_count) AS BIGINT) AS duplicate_count FROM inventory_v""",
    ),
    "latest_input": with_views(
        views.INVENTORY,
        """
        SELECT snapshot_id, extracted_at FROM inventory_v
        ORDER BY extracted_at DESC, snapshot_id LIMIT 1""",
    ),
    "inventory_signature": with_views(
        f"""{views.INVENTORY},
        rows_v AS (SELECT '["' || snapshot_id || '","' || manifest_fingerprint || '"]' AS text_row
          FROM inventory_v)""",
        f"SELECT {_FINGERPRINT} AS input_signature FROM rows_v",
    ),
    "content_fingerprint": f"""
        WITH rows_v AS (
          SELECT 's' || (event_id % 4) AS snapshot_id, '["' || event_id || '","' || event_type || '","'
            || replace(props, '"', '\\"') || '"]' AS text_row FROM events)
        SELECT snapshot_id, {_FINGERPRINT} AS fingerprint FROM rows_v GROUP BY 1""",
    "history_union": with_views(
        views.VERSIONS,
        """
        SELECT snapshot_id, count(*) AS versions,
          CAST(sum(total_amount) AS DECIMAL(38,2)) AS total_amount FROM versions_v GROUP BY 1""",
    ),
    "approved_history": with_views(
        views.VERSIONS,
        """
        SELECT snapshot_id, order_id, updated_at, payload_hash FROM versions_v
        WHERE snapshot_id NOT IN ('s1', 's3')""",
    ),
    "missing_prior_inputs": with_views(_CHECKS, "SELECT * FROM missing_v"),
    "excluded_inputs": with_views(_CHECKS, "SELECT * FROM excluded_v"),
    "altered_inputs": with_views(_CHECKS, "SELECT * FROM altered_v"),
    "publish_guard": with_views(
        _CHECKS,
        """
        SELECT 'missing_prior' AS rule, count(*) AS failures, count(*) = 0 AS allowed FROM missing_v
        UNION ALL SELECT 'excluded', count(*), count(*) = 0 FROM excluded_v
        UNION ALL SELECT 'altered', count(*), count(*) = 0 FROM altered_v""",
    ),
    "release_status": f"""
        WITH pointer_v AS (
          SELECT max(ts) FILTER (event_type = 'purchase') AS first_at, max(ts) AS last_at,
            count(*) FILTER (event_type = 'error') AS rejected_count,
            count(*) FILTER (event_type = 'view') AS duplicate_count FROM events),
        ages_v AS (
          SELECT *, (epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(first_at)) / 3600000000.0 AS a,
            (epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(last_at)) / 3600000000.0 AS b
          FROM pointer_v)
        SELECT 'r1' AS release_id, {_iso('first_at')} AS published_at, CAST(10 AS INTEGER) AS data_tests_passed,
          rejected_count, duplicate_count, CAST(a AS DOUBLE) AS publication_age_hours,
          CAST(b AS DOUBLE) AS latest_extraction_age_hours, greatest(a, b) > 24 AS stale FROM ages_v""",
    "lineage_trace": with_views(
        f"""{views.CURRENT},
        groups_v AS (
          SELECT CAST(created_at AS DATE) AS order_date, channel, currency FROM current_v
          WHERE status NOT IN ('CANCELED', 'DRAFT') GROUP BY 1, 2, 3 HAVING sum(total_amount) > 10)""",
        """
        SELECT g.order_date, g.channel, g.currency, c.order_id, c.snapshot_id,
          v.event_id + 1 AS line_number
        FROM current_v c JOIN groups_v g ON CAST(c.created_at AS DATE) = g.order_date
          AND c.channel = g.channel AND c.currency = g.currency
        JOIN versions_v v ON v.snapshot_id = c.snapshot_id AND v.order_id = c.order_id
          AND v.updated_at = c.updated_at
        WHERE c.status NOT IN ('CANCELED', 'DRAFT')""",
    ),
}
