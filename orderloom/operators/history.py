"""Version history and current state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.operators import skew

ORDER_VERSION_COLUMNS = (
    "order_id",
    "order_number",
    "channel",
    "currency",
    "status",
    "created_at",
    "updated_at",
    "total_amount",
    "payload_json",
    "payload_hash",
    "snapshot_id",
)
LINE_VERSION_COLUMNS = (
    "order_id",
    "line_id",
    "product_name",
    "sku",
    "quantity",
    "unit_amount",
    "line_amount",
    "payload_hash",
    "snapshot_id",
)


def approved(history: DataFrame, manifests: DataFrame, exclusions: DataFrame) -> DataFrame:
    """History rows of snapshots that passed their gate and are not excluded.

    Snapshots are chosen first, one row each; history meets only the short list, and one
    snapshot with a large share of the rows does not end up in one task.
    """
    passed = manifests.filter(F.col("quality_gate") == "passed").select("snapshot_id")
    chosen = without_excluded(passed, exclusions)
    return skew.keep_matching_few(history, chosen, ["snapshot_id"], "order_id")


def without_excluded(history: DataFrame, exclusions: DataFrame) -> DataFrame:
    """History minus excluded snapshots."""
    return history.join(exclusions.select("snapshot_id"), "snapshot_id", "left_anti")


def order_versions(history: DataFrame) -> DataFrame:
    """Staging view of order versions."""
    return history.select(*ORDER_VERSION_COLUMNS)


def line_versions(history: DataFrame, *others: str) -> DataFrame:
    """Staging view of line versions: one row per line of every stored version.

    ``others`` are further columns of the version that its lines keep.
    """
    lines = history.select("order_id", "payload_hash", "snapshot_id", *others, F.inline("lines"))
    return lines.select(*LINE_VERSION_COLUMNS, *others)


def current_orders(versions: DataFrame) -> DataFrame:
    """Latest version per order; later snapshot, then larger payload text, break ties.

    The rank filter becomes a per-task limit ahead of the shuffle, so an order with very
    many versions sends one row per task.
    """
    latest = Window.partitionBy("order_id").orderBy(
        F.col("updated_at").desc(), F.col("snapshot_id").desc(), F.col("payload_json").desc()
    )
    return (
        versions.withColumn("version_rank", F.row_number().over(latest))
        .filter(F.col("version_rank") == 1)
        .drop("version_rank")
    )


def contested_orders(versions: DataFrame) -> DataFrame:
    """IDs of the orders with more than one version; only IDs and counts are shuffled."""
    counted = versions.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_versions"))
    return counted.filter(F.col("n_versions") > 1).select("order_id")


def latest_versions(versions: DataFrame, contested: DataFrame, most: int = skew.MAX_SENT_KEYS) -> DataFrame:
    """The same as ``current_orders``; only the versions of contested orders are ranked and moved.

    Beyond ``most`` contested orders, which are not broadcast any more, all versions are ranked.
    """
    n = contested.limit(most + 1).count()
    if n > most:
        return current_orders(versions)
    if not n:
        return versions
    ids = F.broadcast(contested)
    alone = versions.join(ids, "order_id", "left_anti")
    return alone.unionByName(current_orders(versions.join(ids, "order_id", "left_semi")))


def replacements(state: DataFrame, added: DataFrame) -> DataFrame:
    """``(order_id, old_part, part)`` of the orders that versions of new snapshots change.

    ``state`` has one row per order and its ``part``; ``added`` the latest of the new versions of an
    order. They come from other snapshots than the state, so the snapshot decides between versions
    of one time. ``old_part`` is null for an order that is new.
    """
    old = state.select(
        "order_id", F.col("part").alias("old_part"), F.struct("updated_at", "snapshot_id").alias("_old")
    )
    new = added.select("order_id", "part", F.struct("updated_at", "snapshot_id").alias("_new"))
    later = F.col("_old").isNull() | (F.col("_new") > F.col("_old"))
    return new.join(old, "order_id", "left").filter(later).select("order_id", "old_part", "part")


def current_order_lines(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines of the chosen versions, by join on the flattened history."""
    chosen = orders.select("order_id", "snapshot_id", "payload_hash")
    return lines.join(chosen, ["order_id", "snapshot_id", "payload_hash"]).select(*lines.columns)


def lines_of(orders: DataFrame) -> DataFrame:
    """Lines of orders that still carry them nested: no join and no shuffle."""
    return line_versions(orders)
