"""Line dedup by distinct-site spread, in DataFrame functions only.

HyperLogLog sketches of the sites of each line merge by aggregation. A line clearly above its
limit is boilerplate, one clearly below is not, and for the lines near it the sites are counted
exactly. Of a boilerplate line one occurrence stays, so that text which was copied as a whole is
not lost from the corpus: the first of equal texts keeps it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.work import Positions, discard, few, stage

#: Distinct sites from which on a line is boilerplate.
MIN_SITES = 5
#: Characters of a line that repeats by chance on so few sites no more. A shorter line needs as many
#: times more sites as it is shorter, all sites at most.
FULL_CHARS = 25
SKETCH_BITS = 8
#: An estimate within this share of the limit is counted exactly: over six standard errors of
#: a sketch with 2^8 registers (1.04 / 16 each).
NEAR = 0.4

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def line_keys(line: Column) -> list[Column]:
    """128 bits that stand for a line."""
    return [F.xxhash64(line), F.xxhash64(F.lit("line"), line)]


def lines_of(rows: DataFrame) -> DataFrame:
    """(doc_id, body, site, position, chars, k1, k2) of every line that is not blank."""
    return (
        rows.select(
            "doc_id",
            F.xxhash64("text").alias("body"),
            F.col("source").alias("site"),
            F.posexplode(F.split("text", "\n")).alias("position", "raw"),
        )
        .withColumn("line", F.btrim("raw", F.lit(SPACE)))
        .filter("line <> ''")
        .select(
            "doc_id",
            "body",
            "site",
            "position",
            F.length("line").alias("chars"),
            *[k.alias(f"k{i}") for i, k in enumerate(line_keys(F.col("line")), 1)],
        )
    )


def needed_sites(chars: Column, all_sites: int, min_sites: int, full_chars: int) -> Column:
    """On how many distinct sites a line of so many characters is boilerplate."""
    more = F.ceil(F.lit(min_sites * full_chars) / chars)
    return F.greatest(F.lit(min_sites), F.least(F.lit(all_sites), more))


def boilerplate_places(rows: DataFrame, min_sites: int, full_chars: int) -> DataFrame:
    """(doc_id, body, position) of every boilerplate line but the first occurrence of each.

    ``rows`` has doc_id, text and source. Texts are split twice: to sketch the sites of all lines,
    and to find the places of those that are above the limit or near it.
    """
    all_sites = rows.agg(F.count_distinct("source")).first()[0]
    lines = lines_of(rows)
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "body", "position")
    needed = needed_sites(F.col("chars"), all_sites, min_sites, full_chars)
    spread = stage(
        lines.groupBy("k1", "k2")
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_BITS)).alias("sites"),
            F.min(place).alias("first"),
            F.min("chars").alias("chars"),
        )
        .withColumn("needed", needed)
        .filter(F.col("sites") >= F.col("needed") * (1 - NEAR))
        .withColumn("sure", F.col("sites") > F.col("needed") * (1 + NEAR))
        .drop("chars", "sites"),
        "line-spread",
    )
    found = stage(
        lines.join(few(spread), ["k1", "k2"])
        .withColumn("is_first", place == F.col("first"))
        .select("k1", "k2", "doc_id", "body", "position", "site", "needed", "sure", "is_first"),
        "line-places",
    )
    exact = (
        found.filter("not sure and site is not null")
        .groupBy("k1", "k2", "needed", "site")
        .agg(F.lit(1).alias("one"))
        .groupBy("k1", "k2", "needed")
        .agg(F.count("*").alias("exact_sites"))
        .filter("exact_sites >= needed")
        .select("k1", "k2")
    )
    near = found.filter("not sure").join(exact, ["k1", "k2"], "left_semi")
    removed = stage(
        found.filter("sure")
        .unionByName(near)
        .filter("not is_first")
        .select("doc_id", "body", "position"),
        "boilerplate",
    )
    discard(spread)
    discard(found)
    return removed


def remove_boilerplate(
    docs: DataFrame, min_sites: int = MIN_SITES, full_chars: int = FULL_CHARS
) -> DataFrame:
    """``docs`` with its columns, where ``text`` lacks all but the first occurrence of each line
    that stands on enough distinct sources.

    That is ``min_sites`` for lines of ``full_chars`` characters or more. Shorter ones, which also
    repeat by chance, need as many times more sites as they are shorter, but never more than there
    are (``needed_sites``). Lines are compared without white space at their ends, and blank lines
    stay. The first occurrence is the one with the smallest (doc_id, hash of the text, line
    number); a null doc_id comes last, and rows alike in doc_id and text are changed alike. So the
    first of equal texts keeps what the others lose. A null text stays null, a null source is no
    site, an empty table gives no rows. Texts without boilerplate are unchanged to the character;
    one that is nothing else becomes empty. A text of any number of lines is one row.
    """
    given = Positions(docs)
    removed = stage(
        boilerplate_places(given.pick("doc_id", "text", "source"), min_sites, full_chars)
        .groupBy(F.col("doc_id").alias("at_id"), F.col("body").alias("at_body"))
        .agg(F.collect_set("position").alias("gone")),
        "removed-lines",
    )
    text = given["text"]
    # As many rows as changed texts: grows with the corpus, so it is never broadcast by us.
    joined = given.rows.join(
        removed,
        given["doc_id"].eqNullSafe(F.col("at_id")) & (F.xxhash64(text) == F.col("at_body")),
        "left",
    )
    left = F.array_join(
        F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains("gone", i)), "\n"
    )
    return given.restore(joined, text=F.when(F.col("gone").isNull(), text).otherwise(left))
