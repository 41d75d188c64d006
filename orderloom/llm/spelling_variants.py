"""Spelling variants of a vocabulary, found with pivotal bigrams.

All bigrams have one global order, rare ones first. A word's *prefix* is its three first bigrams in
that order (with all that tie with the third), its *pivots* are two disjoint ones of the prefix of
least total frequency, chosen by dynamic programming. One edit spoils at most one of two disjoint
bigrams, and what stands in both words among the bigrams of a prefix is in the other's prefix if
that reaches as far; so of two words at one edit, the one whose prefix ends earlier has a pivot
in the prefix of the other.

Position limits: an edit right of the left pivot leaves all up to that pivot in place; any other
leaves all from the right pivot on, shifted by the difference in length. Therefore the left pivot
is looked up with everything before it, the right one with everything behind it, each for the three
lengths that one edit allows. Pairs found are verified by their edit distance.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.work import discard, stage

#: Least code points and occurrences of a word.
MIN_LENGTH = 6
MIN_COUNT = 5
#: How many times as often as a word its form occurs at least.
FORM_RATIO = 5
#: Classes that bigrams are counted in: bounds the table that tasks get, for any alphabet.
CLASSES = 1 << 16
#: Different words a task counts before it hands them on.
HELD_WORDS = 400_000

#: Maximal runs of letters, after ASCII letters were made small.
RUNS = re.compile("[a-zÀ-ÿ]+")

_WORD_COUNT = "word string, n long"


def _damaged(run: str, seed: int, every: int) -> str:
    """``run`` without one code point if its hash is divisible by ``every``."""
    drawn = crc32(run.encode(), seed)
    if drawn % every:
        return run
    place = drawn % len(run)
    return run[:place] + run[place + 1 :]


def _count_runs(every: int | None, min_length: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                if text is None:
                    continue
                found = Counter(r for r in RUNS.findall(text.lower().decode()) if len(r) >= min_length)
                if every and doc_id is not None:
                    seed = crc32(f"{doc_id}:".encode())
                    for run, n in found.items():
                        word = _damaged(run, seed, every)
                        if len(word) >= min_length:
                            counts[word] += n
                else:
                    counts.update(found)
                if len(counts) > HELD_WORDS:
                    yield _as_batch(counts)
                    counts = Counter()
        if counts:
            yield _as_batch(counts)

    return count


def _as_batch(counts: Counter) -> pa.RecordBatch:
    made = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
    return pa.record_batch(made, names=["word", "n"])


def word_counts(
    docs: DataFrame, every: int | None = None, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT
) -> DataFrame:
    """(word, n) of the runs of letters in all texts that are long and frequent enough.

    Only A to Z are made small. With ``every``, one run of that many loses a code point, drawn
    from document and run: planted misspellings. Null texts hold no runs; the runs of a null
    ``doc_id`` are never damaged; no documents give no words.
    """
    counted = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(
        _count_runs(every, min_length), _WORD_COUNT
    )
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _class(gram: str) -> int:
    return crc32(gram.encode()) % CLASSES


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams: Counter[str] = Counter()
        for word in batch.column("word").to_pylist():
            grams.update(map(str.__add__, word, word[1:]))
        classes: Counter[int] = Counter()
        for gram, n in grams.items():
            classes[_class(gram)] += n
        made = [pa.array(list(classes), pa.int32()), pa.array(list(classes.values()), pa.int64())]
        yield pa.record_batch(made, names=["class", "n"])


def gram_counts(words: DataFrame) -> np.ndarray:
    """How often the bigrams of each class occur in the vocabulary; at most ``CLASSES`` rows."""
    counts = np.zeros(CLASSES, np.int64)
    rows = words.select("word").mapInArrow(_count_grams, "class int, n long")
    for row in rows.groupBy("class").agg(F.sum("n").alias("n")).collect():
        counts[row["class"]] = row["n"]
    return counts


def pivots(places: list[int], cost: list[int]) -> tuple[int, int]:
    """Two disjoint bigrams of least total cost among those at ``places``, in increasing order.

    Runs over the places and keeps the cheapest single one that ends before each.
    """
    best = None
    cheapest, done = None, 0
    for place, price in zip(places, cost, strict=True):
        while places[done] <= place - 2:
            if cheapest is None or cost[done] < cheapest[0]:
                cheapest = (cost[done], places[done])
            done += 1
        if cheapest and (best is None or cheapest[0] + price < best[0]):
            best = (cheapest[0] + price, cheapest[1], place)
    return best[1], best[2]


def selected(word: str, frequency) -> tuple[list[int], int, int, tuple[int, str]]:
    """Places of the prefix, the two pivots, and where the prefix ends in the global order."""
    order = [(frequency(gram), gram) for gram in map(str.__add__, word, word[1:])]
    last = sorted(order)[2]
    places = [place for place, rank in enumerate(order) if rank <= last]
    left, right = pivots(places, [order[place][0] for place in places])
    return places, left, right, last


def _index(counts: np.ndarray):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}

        def frequency(gram: str) -> int:
            if gram not in known:
                if len(known) > CLASSES:
                    known.clear()
                known[gram] = int(counts[_class(gram)])
            return known[gram]

        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            rows = zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True)
            for word, n in rows:
                places, left, right, last = selected(word, frequency)
                size = len(word)
                entries = [("<" + word[: left + 2], True, size + d) for d in (-1, 0, 1)]
                entries += [(">" + word[right:], True, size + d) for d in (-1, 0, 1)]
                for place in places:
                    entries.append(("<" + word[: place + 2], False, size))
                    entries.append((">" + word[place:], False, size))
                for piece, is_pivot, length in entries:
                    row = (word, n, *last, piece, length, is_pivot)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.bool_()]
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["word", "n", "last_count", "last_gram", "piece", "length", "is_pivot"],
            )

    return index


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n): both directions of every pair at one edit; ``words`` has (word, n).

    Words must differ and have at least four code points, so that there are three bigrams.
    """
    entries = words.mapInArrow(
        _index(gram_counts(words)),
        "word string, n long, last_count long, last_gram string, piece string, length int, "
        "is_pivot boolean",
    )
    entries = stage(entries, "gram-index")

    def side(name: str, is_pivot: bool) -> DataFrame:
        rows = entries.filter(F.col("is_pivot") == is_pivot)
        return rows.select(
            "piece",
            "length",
            F.col("word").alias(name),
            F.col("n").alias(f"{name}_n"),
            F.struct("last_count", "last_gram").alias(f"{name}_last"),
        )

    found = (
        side("a", True)
        .join(side("b", False), ["piece", "length"])
        .filter("a_last <= b_last and a <> b")
        .filter(F.levenshtein("a", "b", 1) == 1)
        .select("a", "a_n", "b", "b_n")
    )
    both = found.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
    both = both.union(found.select("b", "a", "a_n"))
    pairs = stage(both.distinct(), "near-words")
    discard(entries)
    return pairs


def roots(links: DataFrame) -> DataFrame:
    """(word, root): where the links ``(word, form)`` of a forest end, by pointer jumping."""
    current = stage(links.select("word", F.col("form").alias("root")), "word-roots")
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = stage(current.join(onward, "root", "left"), "word-jumps")
        discard(current)
        moved = not joined.filter("further is not null").isEmpty()
        current = joined.select("word", F.coalesce("further", "root").alias("root"))
        if not moved:
            return current
        current = stage(current, "word-roots")
        discard(joined)


def variants(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """Words of ``words(word, n)`` with their form, root and near words.

    ``n_near`` counts the words that differ by one inserted, deleted or replaced code point.
    ``form`` is the most frequent of them (the first in code-point order of equally frequent ones)
    if it occurs ``ratio`` times as often as the word, which rises along every chain of forms;
    ``root`` is the end of that chain, the word itself if it has no form. Words are taken once
    each; repeated ones have their counts added. Null words and those of fewer than four code
    points are near none.
    """
    words = stage(words.groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    pairs = near_pairs(words.filter(F.length("word") >= 4))
    best = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
    )
    form_n = -F.col("best.less")
    is_form: Column = form_n >= ratio * F.col("n")
    judged = stage(
        words.join(best, "word", "left").select(
            "word",
            F.when(is_form, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, form_n).alias("form_n"),
        ),
        "judged-words",
    )
    discard(pairs)
    ends = roots(judged.filter("form is not null"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
