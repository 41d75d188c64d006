"""Language identification as inference of a multilingual mixture.

A text's character trigrams are drawn from a mixture of languages. Expectation-maximisation
estimates the proportions of the mixture from the likelihoods of the trigrams, and the set of
languages is the one with the best penalised likelihood. The text's language is the largest part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.work import Positions

#: Labelled texts a language is learned from, about; chosen by a hash.
TRAINING_TEXTS = 3_000
#: Trigrams are hashed to so many cells.
CELLS = 1 << 15
SMOOTHING = 0.5
STEPS = 20
#: Log likelihood that a further language has to gain, for each unit of log of the length.
PENALTY = 2.0
UNKNOWN = "und"
#: Characters whose trigrams are made at once.
BLOCK = 1 << 20


@cache
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def cells(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The cells of a text's trigrams and how often each occurs. Words are runs of letters,
    lower-cased, with a blank around; trigrams do not go across words."""
    found = np.zeros(0, np.int64)
    total: list[tuple[np.ndarray, np.ndarray]] = []
    low = text.lower()
    for at in range(0, len(low), BLOCK):
        part = low[max(0, at - 2) : at + BLOCK]
        code = np.frombuffer(f" {part} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = letters()[code]
        code = np.where(is_letter, code, 32).astype(np.uint64)
        inner = is_letter[1:-1]
        key = (code[:-2] * 0x9E3779B1 + code[1:-1] * 0x85EBCA77 + code[2:] * 0xC2B2AE3D)[inner]
        key = (key ^ (key >> np.uint64(15))) * np.uint64(0x2C1B3C6D)
        found = ((key >> np.uint64(12)) % np.uint64(CELLS)).astype(np.int64)
        total.append(np.unique(found, return_counts=True))
    if not total:
        return found, found
    if len(total) == 1:
        return total[0]
    where = np.concatenate([t[0] for t in total])
    unique, back = np.unique(where, return_inverse=True)
    return unique, np.bincount(back, np.concatenate([t[1] for t in total])).astype(np.int64)


class Model:
    """Languages in order, and the likelihood of each cell under each."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts + SMOOTHING
        self.likelihood = (smooth / smooth.sum(axis=1, keepdims=True)).T.copy()


def proportions(likelihood: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions of the mixture by expectation-maximisation, and its log likelihood."""
    share = np.full(likelihood.shape[1], 1 / likelihood.shape[1])
    total = counts.sum()
    for _ in range(STEPS if len(share) > 1 else 0):
        mixed = likelihood @ share
        following = share * ((counts / mixed) @ likelihood) / total
        moved = np.abs(following - share).max()
        share = following
        if moved < 1e-4:
            break
    return share, float(counts @ np.log(likelihood @ share))


def languages_of(text: str | None, model: Model) -> dict[str, float]:
    """The languages of a text and their proportions, the largest first; empty without letters.

    All languages are mixed first. Then sets of the largest ones compete, each language of a set
    paying the penalty.
    """
    where, counts = cells(text or "")
    if not len(where) or not model.languages:
        return {}
    counts = counts.astype(float)
    likelihood = model.likelihood[where]
    share, _ = proportions(likelihood, counts)
    ranked = np.argsort(-share, kind="stable")
    price = PENALTY * np.log(counts.sum() + 1)
    best, chosen = -np.inf, {}
    for size in range(1, len(ranked) + 1):
        members = np.sort(ranked[:size])
        parts, fit = proportions(likelihood[:, members], counts)
        if fit - size * price <= best:
            break
        best = fit - size * price
        chosen = {model.languages[m]: float(p) for m, p in zip(members, parts, strict=True)}
    return dict(sorted(chosen.items(), key=lambda x: (-x[1], x[0])))


def fit(labelled: DataFrame, training_texts: int = TRAINING_TEXTS) -> Model:
    """A model of ``labelled(text, lang)``, from about ``training_texts`` texts a language. Rows
    without text or language teach nothing."""
    rows = labelled.filter("text is not null and lang is not null")
    sizes = dict(rows.groupBy("lang").count().collect())
    names = sorted(sizes)
    unit = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / float(1 << 40)
    limits = [(name, min(1.0, training_texts / sizes[name])) for name in names]
    taken = F.lit(False)
    for name, share in limits:
        taken = taken | ((F.col("lang") == name) & (unit < share))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {name: np.zeros(CELLS, np.int64) for name in names}
        for batch in batches:
            for text, name in zip(batch.column(0), batch.column(1), strict=True):
                where, counts = cells(text.as_py())
                total[name.as_py()][where] += counts
        for name, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(counts[at])],
                names=["lang", "cell", "n"],
            )

    counted = rows.filter(taken).select("text", "lang").mapInArrow(
        run, "lang string, cell long, n long"
    )
    counts = np.zeros((len(names), CELLS))
    number = {name: i for i, name in enumerate(names)}
    for name, cell, n in counted.groupBy("lang", "cell").agg(F.sum("n")).collect():
        counts[number[name], cell] = n
    return Model(names, counts)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, languages) of every row of ``docs(doc_id, text)``.

    ``languages`` are the chosen set with their proportions, ``score`` is the largest of them. A
    text that is null, empty or without letters is ``und`` with score 0 and no languages. Repeated
    rows are judged alike, ties go to the name that sorts first, an empty table gives no rows.
    """
    rows = Positions(docs).pick("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [languages_of(text.as_py(), model) for text in batch.column(1)]
            first = [next(iter(f.items()), (UNKNOWN, 0.0)) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([name for name, _ in first], pa.string()),
                    pa.array([min(1.0, score) for _, score in first], pa.float64()),
                    pa.array([list(f.items()) for f in found], pa.map_(pa.string(), pa.float64())),
                ],
                names=["doc_id", "lang_pred", "score", "languages"],
            )

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, languages map<string, double>"
    )
