"""Packing of documents into sequences of a fixed length, as a cutting-stock problem.

Documents are cut into whole and half sequences and a rest. The pieces are counted by size, sizes
are joined into classes, a linear program over the counts finds patterns of classes that fill a
sequence, and the pieces of a class, ranked over the whole corpus, take the places that the
patterns have for it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.cutting_stock import classes, cut, places
from orderloom.llm.word_tokens import encoder
from orderloom.llm.work import Positions, discard, few, stage

LENGTH = 2048
#: Id put after each document.
END_ID = 1

PIECES = (
    "start long, length long, ids_crc32 long, doc_tokens long, part int, rank_in_part long"
)


def document_ids(text: str | None, path: str, end_id: int) -> bytes:
    return encoder(path).encode(text or "") + end_id.to_bytes(4, "little")


def cuts(tokens: int, length: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document of so many tokens.

    Cuts are at whole sequences, and a rest longer than half a sequence is cut there once more:
    two halves fill a sequence, and the shorter rests combine well.
    """
    start, half = 0, length // 2
    while (left := tokens - start) > 0:
        count = length if left >= length else half if left > half else left
        yield start, count
        start += count


def pieces(docs: DataFrame, path: str, length: int, end_id: int) -> DataFrame:
    """A row for each piece of each document. ``rank_in_part`` counts the pieces of a size that
    the same task wrote before; with the task's number it names the piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows, rows_of = [], []
            for i, text in enumerate(batch.column(1)):
                ids = memoryview(document_ids(text.as_py(), path, end_id))
                tokens = len(ids) // 4
                for start, count in cuts(tokens, length):
                    check = crc32(ids[4 * start : 4 * (start + count)])
                    rows.append((start, count, check, tokens, part, seen[count]))
                    rows_of.append(i)
                    seen[count] += 1
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int32() if n == 4 else pa.int64() for n in range(6)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows_of, pa.int64())),
                    *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ],
                names=["doc_id", *[p.split()[0] for p in PIECES.split(", ")]],
            )

    rows = Positions(docs).pick("doc_id", "text")
    doc_type = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {doc_type}, {PIECES}")


def pack(
    docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document, with ``end_id`` after it, is in exactly one piece. A null or empty
    text is the end id alone. Rows are documents of their own, whether doc_id is null or repeated.
    Offsets in a sequence are gapless from 0; its end is padded by the reader. An empty table
    gives no rows. ``path`` names a tokenizer file that every executor has.
    """
    cutting = stage(pieces(docs, path, length, end_id), "pieces")
    counts = stage(cutting.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = sorted(tuple(r) for r in counts.groupBy("length").agg(F.sum("n")).collect())
    sizes = np.array([s for s, _ in histogram], np.int64)
    demand = np.array([n for _, n in histogram], np.int64)
    class_of_size = classes(sizes, demand)
    class_sizes, class_of = np.unique(class_of_size, return_inverse=True)
    class_demand = np.bincount(class_of, demand, len(class_sizes)).astype(np.int64)
    table = places(cut(class_sizes, class_demand, length), class_sizes)
    # The pieces of a class are ranked size by size.
    of_size, first_rank = np.zeros(length + 1, np.int64), np.zeros(length + 1, np.int64)
    of_size[sizes] = class_of_size
    first_rank[sizes] = np.cumsum(demand) - demand
    first_rank[sizes] -= first_rank[sizes[np.searchsorted(class_of, np.arange(len(class_sizes)))]][class_of]
    before = F.sum("n").over(
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = stage(
        counts.select("part", "length", F.coalesce(before, F.lit(0)).alias("before")), "piece-ranks"
    )
    discard(counts)
    ranked = cutting.join(few(offsets), ["part", "length"]).select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("before") + F.col("rank_in_part")).alias("rank"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = table["size"] << 44 | table["rank"]
        for batch in batches:
            count = batch.column("length").to_numpy()
            size, rank = of_size[count], batch.column("rank").to_numpy() + first_rank[count]
            at = np.searchsorted(key, size << 44 | rank, side="right") - 1
            over, each = rank - table["rank"][at], table["each"][at]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:5],
                    pa.array(table["sequence"][at] + over // each),
                    pa.array(table["slot"][at] + over % each),
                ],
                names=[*batch.schema.names[:5], "sequence_id", "slot"],
            )

    head = ", ".join(f"{c.name} {c.dataType.simpleString()}" for c in ranked.schema[:5])
    placed = ranked.mapInArrow(run, f"{head}, sequence_id long, slot long")
    offset = F.sum("length").over(
        Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.withColumn("offset", F.coalesce(offset, F.lit(0))).drop("slot")


def sequences(
    docs: DataFrame, packed: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID
) -> DataFrame:
    """(sequence_id, ids array<int>) of the sequences that ``pack`` laid out, unpadded.

    Needs doc_ids that are unique and not null. Ids come from the texts again, so that the
    layout itself moves no tokens.
    """
    rows = Positions(docs).pick("doc_id", "text")
    wanted = packed.groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("cuts")
    )
    joined = rows.join(wanted, "doc_id").select("text", "cuts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, cuts in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.frombuffer(document_ids(text.as_py(), path, end_id), "<u4")
                for c in cuts.as_py():
                    end = c["start"] + c["length"]
                    out.append((c["sequence_id"], c["offset"], ids[c["start"] : end]))
            names = ["sequence_id", "offset", "piece"]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32())]
            columns = list(zip(*out, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

    pieces_of = joined.mapInArrow(run, "sequence_id long, offset long, piece array<int>")
    return pieces_of.groupBy("sequence_id").agg(
        F.flatten(
            F.transform(F.array_sort(F.collect_list(F.struct("offset", "piece"))), lambda p: p["piece"])
        ).alias("ids")
    )
