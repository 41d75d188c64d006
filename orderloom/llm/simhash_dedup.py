"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``max_bits`` of each other have a value that is within half of that of
both. So every distinct fingerprint emits all values around it, and a shuffle on these values
brings every linked pair together.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.graph import components
from orderloom.llm.work import Positions, few, stage

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of a text; zero for a text without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = min(shingle_words, len(words)) - 1
    spans = zip(starts[: len(words) - last].tolist(), ends[last:].tolist(), strict=True)
    digest, count = xxhash.xxh64_intdigest, len(words) - last
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for i in range(0, count, BLOCK):
        octets = hashes[i : i + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fingerprint long) of every row of ``docs``; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text.as_py(), shingle_words) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, pa.int64())], names=["doc_id", "fingerprint"]
            )

    rows = Positions(docs).pick("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, fingerprint long")


def ball(bits: int) -> list[int]:
    """All signed 64-bit masks with at most ``bits`` ones."""
    masks = [
        sum(1 << b for b in ones) for k in range(bits + 1) for ones in combinations(range(64), k)
    ]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) between the fingerprints of ``distinct``, enough to connect all that are
    within ``max_bits``; every edge is verified.

    Around a shared value all fingerprints within the smaller half are linked with all within
    the larger half, as their distances add up. So one of the near ones serves as centre for the
    rest, and no pairs within a group are emitted. A group holds at most a ball of fingerprints.
    """
    near = max_bits // 2
    emitted = distinct.select(
        "fingerprint", F.explode(F.array(*map(F.lit, ball(max_bits - near)))).alias("mask")
    ).select(
        "fingerprint",
        F.col("fingerprint").bitwiseXOR(F.col("mask")).alias("variant"),
        (F.bit_count("mask") <= near).alias("is_near"),
    )
    centre = F.min(F.when(F.col("is_near"), F.col("fingerprint")))
    return (
        emitted.withColumn("centre", centre.over(Window.partitionBy("variant")))
        .filter("centre is not null and centre <> fingerprint")
        .select(F.col("centre").alias("a"), F.col("fingerprint").alias("b"))
        .distinct()
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    )


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, fingerprint long, component_id) for every row of ``docs``.

    ``component_id`` is the smallest doc_id among the documents that are connected through links
    of at most ``max_bits`` differing bits. Texts without words, null or empty, have fingerprint
    zero and link like any other. A null doc_id is never the smallest; a component of only such
    rows has a null id. Repeated rows come back as often as they came. Copies are one
    fingerprint before anything is compared. An empty table gives no rows.
    """
    prints = stage(fingerprints(docs, shingle_words), "fingerprints")
    classes = stage(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "classes"
    )
    found = stage(components(links(classes.select("fingerprint"), max_bits)), "components")
    joined = classes.join(found, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("component")
    )
    smallest = joined.groupBy("component").agg(F.min("first_id").alias("component_id"))
    labels = stage(joined.join(smallest, "component").select("fingerprint", "component_id"), "labels")
    return prints.join(few(labels), "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id.

    Rows without a doc_id stay, as no key names them. Of several rows with one doc_id that
    stays, one is kept.
    """
    given = Positions(docs)
    found = stage(near_duplicates(docs, shingle_words, max_bits), "near-duplicates")
    losers = stage(
        found.filter("doc_id <> component_id").select(F.col("doc_id").alias("loser")).distinct(),
        "losers",
    )
    repeated = stage(
        found.filter("doc_id = component_id")
        .groupBy(F.col("doc_id").alias("again"))
        .count()
        .filter("count > 1")
        .drop("count"),
        "repeated",
    )
    doc_id = given["doc_id"]
    kept = given.rows.join(few(losers), doc_id == F.col("loser"), "left_anti")
    if not repeated.isEmpty():
        again = few(repeated)
        name = given.inner[given.names.index("doc_id")]
        kept = kept.join(again, doc_id == F.col("again"), "left_anti").union(
            kept.join(again, doc_id == F.col("again"), "left_semi").dropDuplicates([name])
        )
    return given.restore(kept)
