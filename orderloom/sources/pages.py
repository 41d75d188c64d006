"""Landed API pages: nodes, and the check that a landing is complete."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions import json_values
from orderloom.session import materialize, prepare


def _connection(page, path: str):
    """A value below the page's connection, with or without an ``orders`` wrapper."""
    return F.coalesce(
        json_values.field(page, f".orders{path}"), json_values.field(page, path)
    )


def _parsed(pages: DataFrame) -> DataFrame:
    prepare(pages.sparkSession)
    return pages.withColumn("_page", json_values.parse_line(F.col("page")))


def nodes(pages: DataFrame) -> DataFrame:
    """One row per order node of each page, as JSON text in ``raw``.

    ``pages`` has the text in ``page``; its other columns stay. ``position`` is the
    place of the node in its page.
    """
    others = [c for c in pages.columns if c != "page"]
    edges = json_values.as_list(_connection(F.col("_page"), ".edges"))
    exploded = _parsed(pages).select(*others, F.posexplode(edges).alias("position", "_edge"))
    return exploded.select(
        *others, "position", F.to_json(json_values.inside(F.col("_edge"), "$.node")).alias("raw")
    )


#: A page cast once: values of the wrong kind become null, level by level; an edge whose node is
#: no object has a null node.
_CONNECTION = (
    "struct<edges array<struct<node struct<id variant>>>, "
    "pageInfo struct<hasNextPage variant, endCursor variant>>"
)


def _page_facts(pages: DataFrame, *by: str) -> DataFrame:
    """What each page says: its request's cursor, the next one, and whether it is whole."""
    text = F.col("page")
    connection = F.coalesce(
        F.try_variant_get(F.col("_page"), "$[0].orders", _CONNECTION),
        F.try_variant_get(F.col("_page"), "$[0]", _CONNECTION),
    )
    read = _parsed(pages).select(
        *by,
        F.nullif(F.col("after"), F.lit("")).alias("_after"),
        json_values.is_whole(F.col("_page"), text).alias("_json"),
        connection.alias("_page"),
    )
    more = F.try_variant_get(F.col("_page.pageInfo.hasNextPage"), "$", "boolean")
    cursor = json_values.as_text(F.col("_page.pageInfo.endCursor"))
    edges = F.col("_page.edges")
    whole = F.coalesce(F.col("_json") & edges.isNotNull() & more.isNotNull(), F.lit(False))
    return read.select(
        *by,
        "_after",
        F.when(more, F.nullif(cursor, F.lit(""))).alias("_next"),
        F.coalesce(more, F.lit(False)).alias("_more"),
        whole.alias("_whole"),
        F.size(F.filter(edges, lambda edge: edge["node"].isNull())).alias("_nodeless"),
    )


_FAULTS = (
    "missing_cursors",
    "repeated_cursors",
    "lost_pages",
    "unnamed_requests",
    "repeated_requests",
    "broken_pages",
    "missing_nodes",
)


def _counts(pages: DataFrame, *by: str) -> DataFrame:
    """Pages, ends and faults of each extraction, in two balanced aggregates."""
    one, zero, more, following = F.lit(1), F.lit(0), F.col("_more"), F.col("_next")

    def entry(cursor, named, **counts):
        """What a page adds to the cursor it names or the one it was requested with."""
        of_page = ("pages", "first", "final", "missing", "broken", "nodeless")
        given = [F.coalesce(counts.get(name, zero), zero).cast("long").alias(name) for name in of_page]
        return F.struct(cursor.alias("cursor"), F.lit(named).cast("long").alias("named"), *given)

    asked = entry(
        F.col("_after"),
        0,
        pages=one,
        first=F.col("_after").isNull().cast("int"),
        final=(F.col("_whole") & ~more).cast("int"),
        missing=(more & following.isNull()).cast("int"),
        broken=(~F.col("_whole")).cast("int"),
        nodeless=F.greatest("_nodeless", zero),
    )
    entries = F.when(following.isNull(), F.array(asked)).otherwise(
        F.array(asked, entry(following, 1))
    )
    per_cursor = (
        pages.select(*by, F.inline(entries))
        .groupBy(*by, "cursor")
        .agg(*[F.sum(n).alias(n) for n in ("named", "pages", "first", "final", "missing", "broken", "nodeless")])
    )
    named, requests = F.col("named"), F.when(F.col("cursor").isNotNull(), F.col("pages"))
    return per_cursor.groupBy(*by).agg(
        F.sum("pages").alias("pages"),
        F.sum("first").alias("first_pages"),
        F.sum("final").alias("final_pages"),
        F.sum("missing").alias("missing_cursors"),
        F.sum(F.greatest(named - 1, zero)).alias("repeated_cursors"),
        F.count_if((named > 0) & (F.col("pages") == 0)).alias("lost_pages"),
        F.count_if((named == 0) & (requests > 0)).alias("unnamed_requests"),
        F.coalesce(F.sum(F.greatest(requests - 1, zero)), zero.cast("long")).alias("repeated_requests"),
        F.sum("broken").alias("broken_pages"),
        F.sum("nodeless").alias("missing_nodes"),
    )


def _is_sound() -> Column:
    """Whether every page has at most one before and one behind it: a path, and perhaps loops."""
    sound = (F.col("final_pages") == 1) & (F.col("first_pages") == 1)
    for fault in _FAULTS:
        sound = sound & (F.col(fault) == 0)
    return sound


#: Rounds of pointer jumping in one plan.
_ROUNDS_A_PLAN = 8


def _steps_to_end(pages: DataFrame, most: int, *by: str) -> DataFrame:
    """``(by, _after, _to, _steps)`` of each page of a sound extraction of at most ``most`` pages.

    Pointer jumping: a page points to the cursor behind it; each round, all pointers move on to
    where the page they point to points. ``_steps`` pages lie between the cursors; ``_to`` is
    null for a page from which the end was reached, and never is for a page in a loop. A round is
    one aggregate by cursor, where the page that ends there and the one that starts there meet.
    """
    start = F.coalesce("_after", F.lit(""))
    jumps = pages.select(
        *by, start.alias("_after"), F.col("_next").alias("_to"), F.lit(1).cast("long").alias("_steps")
    )
    empty = "struct<_after string, _steps bigint>", "struct<_to string, _steps bigint>"
    for number in range(max(most - 1, 1).bit_length()):
        if number and number % _ROUNDS_A_PLAN == 0:
            jumps = materialize(jumps, "page-jumps")
        ends = F.struct("_after", "_steps")
        starts = F.struct("_to", "_steps")
        ending = F.struct(F.col("_to").alias("_key"), ends.alias("_ends"), F.lit(None).cast(empty[1]).alias("_starts"))
        starting = F.struct(F.col("_after").alias("_key"), F.lit(None).cast(empty[0]).alias("_ends"), starts.alias("_starts"))
        met = (
            jumps.select(
                *by,
                F.inline(F.when(F.col("_to").isNull(), F.array(starting)).otherwise(F.array(ending, starting))),
            )
            .groupBy(*by, "_key")
            .agg(F.max("_ends").alias("_ends"), F.max("_starts").alias("_starts"))
        )
        further = F.struct(
            F.col("_ends._after").alias("_after"),
            F.col("_starts._to").alias("_to"),
            (F.col("_ends._steps") + F.col("_starts._steps")).alias("_steps"),
        )
        done = F.struct(
            F.col("_key").alias("_after"), F.col("_starts._to").alias("_to"), F.col("_starts._steps").alias("_steps")
        )
        kept = F.array(
            F.when(F.col("_ends").isNotNull(), further), F.when(F.col("_starts._to").isNull(), done)
        )
        jumps = met.select(*by, F.inline(F.filter(kept, lambda x: x.isNotNull())))
    return jumps


def _ranked(pages: DataFrame, *by: str) -> tuple[DataFrame, DataFrame]:
    """Counts of every extraction, and the steps to the end of each page of the sound ones."""
    facts = materialize(_page_facts(pages, *by), "page-facts")
    counts = materialize(_counts(facts, *by), "page-counts")
    sound = counts.filter(_is_sound())
    most = sound.agg(F.max("pages")).first()[0]
    members = [F.col(f"p.{name}").eqNullSafe(F.col(f"s.{name}")) for name in by]
    together = reduce(Column.__and__, members, F.lit(True))
    linked = facts.alias("p").join(sound.select(*by).alias("s"), together, "left_semi")
    return counts, _steps_to_end(linked, most or 1, *by)


def chain(pages: DataFrame, *by: str) -> DataFrame:
    """Facts on the page chain of each extraction, and whether the landing is ``complete``.

    ``pages`` holds the response in ``page`` and the cursor it was requested with in ``after``,
    null for the first request. In a complete landing one page was requested without a cursor and
    one says that nothing follows; every other names a cursor, no two the same, with which exactly
    one page was requested; every page is whole JSON with a list of edges, says whether more
    follow, and every edge has a node object; and from the first page all others are reached, so
    that no page is lost and none stands in a loop. ``linked_pages`` counts the pages reached; it is
    null when one of the other conditions fails.
    """
    counts, steps = _ranked(pages, *by)
    reached = steps.filter((F.col("_after") == "") & F.col("_to").isNull())
    reached = reached.select(*[F.col(name).alias(f"_{name}") for name in by], F.col("_steps").alias("linked_pages"))
    same = reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in by], F.lit(True))
    complete = F.coalesce(F.col("linked_pages") == F.col("pages"), F.lit(False))
    return (
        counts.join(reached, same, "left")
        .drop(*[f"_{name}" for name in by])
        .withColumn("complete", complete)
    )


def in_order(pages: DataFrame, *by: str) -> DataFrame:
    """``pages`` with ``page_number``, counted from the first page of each complete extraction.

    It is null on all pages of an extraction that is not complete.
    """
    counts, steps = _ranked(pages, *by)
    whole = steps.filter(F.col("_to").isNull()).withColumn(
        "_pages", F.max("_steps").over(Window.partitionBy(*by))
    )
    sizes = counts.select(*[F.col(n).alias(f"_{n}") for n in by], F.col("pages").alias("_size"))
    same = reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in by], F.lit(True))
    numbers = whole.join(sizes, same & (F.col("_pages") == F.col("_size"))).select(
        *[F.col(f"_{n}") for n in by],
        F.col("_after"),
        (F.col("_size") - F.col("_steps") + 1).alias("page_number"),
    )
    here = F.coalesce(F.col("after"), F.lit("")) == F.col("_after")
    return pages.join(numbers, same & here, "left").select(*pages.columns, "page_number")
