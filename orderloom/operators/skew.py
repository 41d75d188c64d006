"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 10_000
SALTS = 32
#: Keys of rows to pick out are broadcast up to so many, some 50 MB of IDs.
MAX_SENT_KEYS = 500_000


def attach(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    count_column: str,
    spread_column: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left-join ``lookup`` (one row per key) to ``rows`` without piling up hot keys.

    ``lookup`` is an aggregate of ``rows`` on the same keys, so the runtime skew join
    cannot split it: its rows come straight out of the aggregate's exchange. Here the
    ``MAX_HOT_KEYS`` heaviest keys above ``hot_rows`` are attached by a broadcast of at
    most that many rows, and their rows are spread by ``spread_column`` (a bigint that
    is unique per row) in the shuffle that serves all other keys. A key outside the
    broadcast holds at most a ``MAX_HOT_KEYS``-th of the rows. Rows with a null key match
    nothing and are spread the same way. ``count_column`` of ``lookup`` holds the rows per
    key.
    """
    values = [c for c in lookup.columns if c not in keys and c != count_column]
    hot = (
        lookup.filter(F.col(count_column) > hot_rows)
        .orderBy(F.col(count_column).desc(), *keys)
        .limit(MAX_HOT_KEYS)
        .select(
            *keys, F.lit(True).alias("_is_hot"), *[F.col(v).alias(f"_hot_{v}") for v in values]
        )
    )
    # Always -1, which is no row's spread value, so spread rows match nothing in the second
    # join. A plain literal would be folded out of the join keys, and with it the spreading.
    cold = lookup.select(
        *keys,
        *[F.col(v).alias(f"_cold_{v}") for v in values],
        F.least(F.col(count_column), F.lit(-1).cast("bigint")).alias("_spread"),
    )
    unkeyed = reduce(Column.__or__, [F.col(key).isNull() for key in keys])
    marked = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "_spread",
        F.when(F.col("_is_hot") | unkeyed, F.col(spread_column))
        .otherwise(F.lit(-1))
        .cast("bigint"),
    )
    joined = marked.join(cold, [*keys, "_spread"], "left")
    return joined.select(
        *[F.col(c) for c in rows.columns],
        *[F.coalesce(f"_hot_{v}", f"_cold_{v}").alias(v) for v in values],
    )


def keep_matching(rows: DataFrame, wanted: DataFrame, keys: list[str], spread_by: str) -> DataFrame:
    """Rows whose keys occur in ``wanted``, a frame much shorter than ``rows``.

    One key may match a large share of the rows, so the rows of a key are dealt out by
    ``spread_by`` over ``SALTS`` copies of it.
    """
    salt = F.pmod(F.xxhash64(spread_by), F.lit(SALTS).cast("bigint"))
    salts = F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))
    copies = wanted.select(*keys, F.explode(salts).alias("_salt"))
    return rows.withColumn("_salt", salt).join(copies, [*keys, "_salt"], "left_semi").drop("_salt")


def few(keys: DataFrame, most: int | None = None) -> bool:
    """Whether a list of keys is short enough to be sent to all tasks."""
    most = MAX_SENT_KEYS if most is None else most
    return keys.limit(most + 1).count() <= most


def sent(keys: DataFrame) -> DataFrame:
    """The keys, broadcast when they are few."""
    return F.broadcast(keys) if few(keys) else keys


def keep_matching_few(
    rows: DataFrame, wanted: DataFrame, keys: list[str], spread_by: str, most: int | None = None
) -> DataFrame:
    """The same for ``wanted`` that is usually short: broadcast when counted as such."""
    most = MAX_HOT_KEYS if most is None else most
    if wanted.limit(most + 1).count() > most:
        return keep_matching(rows, wanted, keys, spread_by)
    return rows.join(F.broadcast(wanted.select(*keys)), keys, "left_semi")
