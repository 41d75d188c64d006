"""Quality rules: repetition inside a text, found with a suffix array.

Words are the symbols. The suffixes of a batch of texts are sorted by prefix doubling;
neighbours in that order with a common prefix of ``window`` words or more form the intervals of
the maximal repeats, and the union of their spans is what a text repeats. Suffixes stop at the
end of their text. Doubling ends beyond the longest repeat that a text of the batch may hold.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.work import Positions

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 10
WINDOW = 5
COVERED_PERCENT = 20
#: Share of a text's words that its longest repeat may hold, and the words that every text may.
LONGEST_PERCENT = 5
LONGEST = 30
#: Words whose suffixes are sorted together; a longer text is sorted by itself.
BATCH_WORDS = 200_000

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "longest_repeat long, allowed_repeat long"
)


def sorted_suffixes(symbols: np.ndarray, deepest: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix order of ``symbols`` by their first ``deepest`` symbols or more, and the ranks by
    1, 2, 4 ... symbols. Equal ranks mean equal prefixes of that length."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    opens = np.ones(n, bool)
    opens[1:] = symbols[order][1:] != symbols[order][:-1]
    rank = np.full(n + 1, -1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(opens, np.arange(n), 0))
    ranks, length = [rank], 1
    while length < deepest:
        single = opens & np.append(opens[1:], True)
        slots = np.flatnonzero(~single)
        if not slots.size:
            break
        at = order[slots]
        pair = rank[at] * (n + 2) + rank[np.minimum(at + length, n)] + 1
        by = np.argsort(pair, kind="stable")
        at, pair = at[by], pair[by]
        order[slots] = at
        opens[slots[1:]] |= pair[1:] != pair[:-1]
        rank = rank.copy()
        rank[at] = np.maximum.accumulate(np.where(opens[slots], slots, 0))
        ranks.append(rank)
        length *= 2
    return order, ranks


def repeats(symbols: np.ndarray, window: int, longest: int) -> np.ndarray:
    """For each position the length of the longest repeat that starts there, 0 below ``window``.
    Lengths over ``longest`` are only known to be over it."""
    found = np.zeros(len(symbols), np.int64)
    order, ranks = sorted_suffixes(symbols, longest + 1)
    base = window.bit_length() - 1
    if len(ranks) <= base:
        return found
    level = ranks[base][order]
    second = np.flatnonzero(level[1:] == level[:-1]) + 1
    left, right = order[second - 1], order[second]
    common = np.zeros(len(second), np.int64)
    end = len(symbols)
    for k in range(len(ranks) - 1, -1, -1):
        rank = ranks[k]
        a, b = left + common, right + common
        same = (a < end) & (b < end)
        same &= rank[np.minimum(a, end)] == rank[np.minimum(b, end)]
        common += same << k
    common[common < window] = 0
    np.maximum.at(found, left, common)
    np.maximum.at(found, right, common)
    return found


def allowed(n_words: int, longest: int, percent: int) -> int:
    """Words of the longest repeat that a text of ``n_words`` may hold."""
    return max(longest, n_words * percent // 100)


def measure(
    texts: Iterable[str], window: int, longest: int, percent: int = LONGEST_PERCENT
) -> list[tuple[int, ...]]:
    """The measures of each text, in the order of ``MEASURES``.

    The longest repeat is counted up to one word more than the text may hold.
    """
    rows, batch, size = [], [], 0

    def flush() -> None:
        if not batch:
            return
        number: dict = defaultdict()
        number.default_factory = number.__len__
        lengths = np.array([len(words) for words in batch])
        ends = np.cumsum(lengths + 1) - 1
        total = int(ends[-1]) + 1
        symbols = np.empty(total, np.int64)
        starts = ends - lengths
        for text_number, (words, start, end) in enumerate(zip(batch, starts, ends, strict=True)):
            symbols[start:end] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
            symbols[start:end] += text_number << 40
            symbols[end] = (len(batch) << 40) + text_number
        limits = [allowed(n, longest, percent) for n in lengths.tolist()]
        reach = repeats(symbols, window, max(limits))
        at = np.flatnonzero(reach)
        change = np.zeros(total + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, np.minimum(at + reach[at], total), -1)
        # A span may be known only to be over all limits; the next starts carry it on.
        covered = np.concatenate([[0], np.cumsum(np.cumsum(change[:-1]) > 0)])
        for start, end, limit in zip(starts.tolist(), ends.tolist(), limits, strict=True):
            most = int(reach[start:end].max()) if end > start else 0
            rows.append((int(covered[end] - covered[start]), min(most, limit + 1), limit))
        batch.clear()

    plain = []
    for text in texts:
        words = text.encode().split()
        spaces = sum(text.count(c) for c in SPACES)
        symbols = sum(text.count(c) for c in SYMBOLS)
        lines = [line for line in text.split("\n") if line.strip(SPACES)]
        plain.append((len(words), len(text) - spaces, symbols, len(lines) - len(set(lines))))
        if batch and size + len(words) > BATCH_WORDS:
            flush()
            size = 0
        batch.append(words)
        size += len(words)
    flush()
    return [a + b for a, b in zip(plain, rows, strict=True)]


def with_measures(
    docs: DataFrame, window: int = WINDOW, longest: int = LONGEST, percent: int = LONGEST_PERCENT
) -> DataFrame:
    """Every column of ``docs`` by position (in0, in1 ...) with the measures of ``text``."""
    given = Positions(docs)
    text_at = given.names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (text.as_py() or "" for text in batch.column(text_at))
            columns = list(zip(*measure(texts, window, longest, percent), strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(c, pa.int64()) for c in columns]],
                names=[*batch.schema.names, *names],
            )

    schema = ", ".join(f"{c.name} {c.dataType.simpleString()}" for c in given.rows.schema)
    names = [part.split()[0] for part in MEASURES.split(", ")]
    return given.rows.mapInArrow(run, f"{schema}, {MEASURES}")


def verdicts(
    docs: DataFrame,
    window: int = WINDOW,
    longest: int = LONGEST,
    min_words: int = MIN_WORDS,
    covered_percent: int = COVERED_PERCENT,
    longest_percent: int = LONGEST_PERCENT,
) -> DataFrame:
    """``docs`` by position with measures, ``base_failed`` and ``kept``.

    A text fails the base rules with fewer than ``min_words`` words or with more than
    ``covered_percent`` of them inside repeats of ``window`` words or more; beyond that, a
    longest repeat of more than ``longest_percent`` of its words fails, if it has more than
    ``longest``. Null and empty texts have no words and fail. Repeated rows are judged alike;
    other columns, null or not, decide nothing. An empty table gives no rows.
    """
    base = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > covered_percent * F.col("n_words")
    )
    fits = F.col("longest_repeat") <= F.col("allowed_repeat")
    return with_measures(docs, window, longest, longest_percent).withColumns(
        {"base_failed": base, "kept": ~base & fits}
    )


def quality(docs: DataFrame, **limits) -> DataFrame:
    """One row per document: doc_id, measures, ``base_failed`` and ``kept``; see ``verdicts``."""
    names = [part.split()[0] for part in MEASURES.split(", ")]
    return verdicts(Positions(docs).pick("doc_id", "text"), **limits).select(
        F.col("in0").alias("doc_id"), *names, "base_failed", "kept"
    )


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they came."""
    return Positions(docs).restore(verdicts(docs, **limits).filter("kept"))
