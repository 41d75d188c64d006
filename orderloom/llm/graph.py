"""Connected components of a graph given by its edges, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.work import discard, stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``: the smallest node it reaches.

    Alternates two steps until only stars are left: each node hands its larger neighbours to its
    smallest one (large star), then its smaller neighbours (small star). Every step is a join
    with one row per node, staged so that the runtime can split a hub's rows. Loops and
    repeated edges are ignored; null ends are dropped; no edges give no rows.
    """
    current = stage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter(F.col("u") != F.col("v"))
        .distinct(),
        "edges",
    )
    while not is_stars(current):
        both = current.select(F.col("u").alias("n"), F.col("v").alias("m")).union(
            current.select(F.col("v").alias("n"), F.col("u").alias("m"))
        )
        lows = stage(
            both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("low")), "large-lows"
        )
        large = stage(
            both.filter("m > n")
            .join(lows, "n")
            .select(F.col("m").alias("u"), F.col("low").alias("v"))
            .distinct(),
            "large-star",
        )
        least = stage(large.groupBy("u").agg(F.min("v").alias("low")), "small-lows")
        small = (
            large.join(least, "u")
            .filter("v <> low")
            .select(F.col("v").alias("u"), F.col("low").alias("v"))
        )
        following = stage(small.union(least.select("u", F.col("low").alias("v"))).distinct(), "edges")
        for used in (current, lows, large, least):
            discard(used)
        current = following
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def is_stars(edges: DataFrame) -> bool:
    """Whether every node of ``edges(u, v)`` either points to one centre or is one."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    nodes = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return nodes.filter("out > 1 or (out = 1 and into = 1)").isEmpty()
