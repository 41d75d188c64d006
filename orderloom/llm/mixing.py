"""Mixing of sources to target weights by Poisson replication.

Every document gets a count drawn from a Poisson distribution whose mean is the repetition rate
of its source: a uniform number made from a hash of seed and document is looked up in the
distribution. The documents are exploded by their counts and shuffled over the whole corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.work import Positions, few, stage

SEED = "mix-1"
#: Exponent that turns the sizes of sources into weights when no weights are given.
TEMPERATURE = 0.7
#: Mean of one draw at most; a larger rate is the sum of several draws.
DRAW_MEAN = 64.0
#: Sources up to which their table, a distribution each, is broadcast.
FEW_SOURCES = 5_000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 digest of the parts."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def poisson_cdf(mean: Column) -> Column:
    """P(X <= 0), P(X <= 1) ... of a mean up to ``DRAW_MEAN``, as far as doubles can tell."""
    last = (mean + 12 * F.sqrt(mean) + 24).cast("int")
    grown = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(
            F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.array(F.exp(-mean)).alias("all")
        ),
        lambda state, k: F.struct(
            (state["p"] * mean / k).alias("p"),
            (state["c"] + state["p"] * mean / k).alias("c"),
            F.concat(state["all"], F.array(state["c"] + state["p"] * mean / k)).alias("all"),
        ),
    )
    return grown["all"]


def rates(docs: DataFrame, weights: DataFrame | None, total: float | None) -> DataFrame:
    """(source, rate): target documents of a source over the documents it has.

    ``weights(source, weight)`` gives the target shares, and sources it lacks get rate zero; by
    default a weight is the number of documents to the power ``TEMPERATURE``. ``total`` is the
    size of the mixture, by default that of the corpus.
    """
    sizes = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(TEMPERATURE)))
    else:
        target = weights.select(
            F.col("source").alias("named"), F.col("weight").cast("double").alias("weight")
        )
        weighed = sizes.join(target, F.col("source").eqNullSafe(F.col("named")), "left").select(
            "source", "n", F.coalesce("weight", F.lit(0.0)).alias("weight")
        )
    # Sums of whole numbers, so that the order of addition cannot show in the last bits.
    whole = F.round(F.col("weight") * 1e6).cast("decimal(38,0)")
    all_weight, all_n = (float(x or 0) for x in weighed.agg(F.sum(whole), F.sum("n")).first())
    size = all_n if total is None else float(total)
    share = whole.cast("double") / F.lit(all_weight) if all_weight else F.lit(0.0)
    return weighed.select("source", (share * F.lit(size) / F.col("n")).alias("rate"))


def mixed(
    docs: DataFrame,
    weights: DataFrame | None = None,
    total: float | None = None,
    seed: str = SEED,
) -> tuple[Positions, DataFrame]:
    """Positions of ``docs``, and its rows with ``rate``, ``copy`` and ``shuffle_key``."""
    given = Positions(docs)
    table = rates(given.pick("source"), weights, total)
    draws = F.greatest(F.ceil(F.col("rate") / DRAW_MEAN), F.lit(1)).cast("int")
    table = stage(
        table.select(
            F.col("source").alias("named"),
            "rate",
            draws.alias("draws"),
            poisson_cdf(F.col("rate") / draws).alias("cdf"),
        ),
        "rates",
    )
    key = F.coalesce(given["doc_id"].cast("string"), F.md5(F.coalesce(given["text"], F.lit(""))))
    ranked = given.rows.join(few(table, FEW_SOURCES), given["source"].eqNullSafe(F.col("named")))
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col("draws")),
        F.lit(0),
        lambda count, draw: count
        + F.size(F.filter("cdf", lambda c: c <= uniform(F.lit(seed), key, draw.cast("string")))),
    )
    copies = (
        ranked.withColumn("copies", drawn)
        .filter("copies > 0")
        .select(
            *given.inner,
            "rate",
            F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"),
        )
    )
    place = F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), key, F.col("copy").cast("string")))
    return given, copies.withColumn("shuffle_key", place)


def mix(docs: DataFrame, partitions: int | None = None, **how) -> DataFrame:
    """The mixture, in random order: ``docs`` with its columns, each row as often as drawn.

    A null source is a source of its own; rows with a null doc_id are told apart by their text.
    Repeated rows are drawn alike. Expected numbers per source follow the weights, whatever the
    sizes; a weight of zero leaves a source out. An empty table gives no rows.
    """
    given, copies = mixed(docs, **how)
    return given.restore(shuffled(copies, partitions))


def shuffled(copies: DataFrame, partitions: int | None = None) -> DataFrame:
    """Globally shuffled: ranges of a random key, in its order.

    The key is uniform, so equal ranges of it are of equal size; nothing is sampled, which would
    draw all copies twice.
    """
    count = partitions or int(copies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leading = F.conv(F.substring("shuffle_key", 1, 8), 16, 10).cast("long")
    place = (leading * count / F.lit(1 << 32)).cast("int")
    return copies.repartitionById(count, place).sortWithinPartitions("shuffle_key")


def replication(docs: DataFrame, **how) -> DataFrame:
    """The mixture with what was decided: doc_id, source, copy (from 0), rate and shuffle_key,
    and the text."""
    given, copies = mixed(docs, **how)
    return shuffled(
        copies.select(
            given["doc_id"].alias("doc_id"),
            given["source"].alias("source"),
            "copy",
            "rate",
            "shuffle_key",
            given["text"].alias("text"),
        )
    )
