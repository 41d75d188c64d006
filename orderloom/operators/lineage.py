"""From a metric row back to the raw lines behind it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderloom.operators import metrics, skew


def orders_behind(groups: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders that make up the given daily metric groups.

    One group may hold a large share of all orders; its orders are dealt out in the join.
    """
    keys = list(metrics.ORDER_GROUP)
    traced = metrics.counted(orders).select(
        *keys, "order_id", "updated_at", "snapshot_id", "payload_hash"
    )
    return skew.keep_matching(traced, groups, keys, "order_id")


def raw_lines_behind(
    groups: DataFrame, orders: DataFrame, accepted: DataFrame, raw: DataFrame
) -> DataFrame:
    """Raw line, snapshot and payload hash of every order in the given groups.

    ``(snapshot_id, order_id, updated_at)`` is unique in ``accepted`` and
    ``(snapshot_id, line_key)`` in ``raw``: both joins have one row per key.
    """
    version = ["snapshot_id", "order_id", "updated_at"]
    traced = orders_behind(groups, orders).join(accepted.select(*version, "line_key"), version)
    evidence = raw.select("snapshot_id", "line_key", "source_file", "line_number", "raw")
    return traced.join(evidence, ["snapshot_id", "line_key"]).drop("line_key")
