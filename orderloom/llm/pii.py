"""Personal data by a semi-Markov conditional random field.

Every run of digits or of token characters offers spans between its borders, several starts and
ends a run, and so does what follows a name such as ``password:``. Whole spans are scored by
features of the span, of its borders and of the text before it; dynamic programming over spans of
bounded length finds the best set of spans that do not overlap, choosing borders and kinds
together. Spans of the base rules always stay; the field adds others beside them.

It is trained here, on a bounded sample of the texts. Right spans are base matches, values after a
name and tokens of a known shape; all other spans of the same texts are wrong. The evidence that
made a span right is withheld from its features: a named value teaches the shape of secrets, a
token of known shape teaches how secrets are named, a phone number is shown without its plus sign.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.work import Positions

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret")

#: Texts with candidates that the field is trained on, about.
TRAINING_TEXTS = 400
EPOCHS = 120
#: What a span that the field adds must score above leaving it out.
MARGIN = 2.0
#: Code points of a span at most that the field considers, and pieces of a token.
LONGEST = 400
MOST_PIECES = 6

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")

#: Runs that may be something personal: digits with joints, and tokens.
NUMBER = re.compile(r"(?<![\w+.])[(+]{0,2}[0-9](?:[\x20().-]{0,2}[0-9])+(?!\w)")
GROUP = re.compile(r"[0-9]+")
FEWEST_DIGITS, MOST_DIGITS = 9, 19
TOKEN = re.compile(r"[A-Za-z0-9_/+=.-]{12,}")
PIECE = re.compile(r"[A-Za-z0-9]+={0,2}")
SHORTEST = 12
#: A long token without digits may be a secret if small and capital letters mix in it.
MIXED_CASE = re.compile(r"[a-z][A-Z].*[a-z][A-Z]")
#: Names of secrets, and the values that follow them.
NAMES = r"(?:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|auth)"
NAMED = re.compile(NAMES + r"\W{0,4}$", re.I)
VALUE = re.compile(NAMES + r"[\"']?\x20?[:=]\x20?[\"']?([^\s\"',;<>]{4,400})", re.I)
#: Shapes of secrets that issuers document.
KNOWN_SHAPE = re.compile(r"A[KS]IA[0-9A-Z]{16}|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}")
BEFORE = 24

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The spans of the four rules, by kind and start. Matches are leftmost and do not overlap
    within a kind; a match that fails its check is dropped and not tried shorter."""
    found: list[Span] = []
    if "@" in text:
        last = 0
        for m in DOMAIN.finditer(text):
            before = text[last : m.start()]
            start = last + len(before.rstrip(LOCAL))
            if start < m.start():
                found.append(("email", start, m.end()))
                last = m.end()
    if not DIGITS.search(text):
        return found
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(DIGITS.findall(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


def number_spans(text: str) -> Iterator[tuple[int, int]]:
    """Spans between digit groups of a run; so few digits each that a run offers few a group."""
    for run in NUMBER.finditer(text):
        groups = [m.span() for m in GROUP.finditer(text, *run.span())]
        for first, (start, _) in enumerate(groups):
            opens = run.start() if first == 0 else start
            digits = 0
            for left, right in groups[first:]:
                digits += right - left
                if digits > MOST_DIGITS:
                    break
                if digits >= FEWEST_DIGITS:
                    yield opens, right


def token_spans(text: str) -> Iterator[tuple[int, int]]:
    """Spans between the joints of a token that may be a secret, and values after a name."""
    for run in TOKEN.finditer(text):
        if not (DIGITS.search(run[0]) or MIXED_CASE.search(run[0])):
            continue
        pieces = [m.span() for m in PIECE.finditer(text, *run.span())]
        for first, (start, _) in enumerate(pieces):
            for _, end in pieces[first : first + MOST_PIECES]:
                if end - start >= SHORTEST:
                    part = text[start:end]
                    if DIGITS.search(part) or MIXED_CASE.search(part):
                        yield start, end
    for value in VALUE.finditer(text):
        yield value.span(1)


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans that the field may choose, by start: at most ``LONGEST`` code points each, and a
    bounded number from each start."""
    found = {*number_spans(text), *token_spans(text)}
    return sorted(s for s in found if s[1] - s[0] <= LONGEST)


def border(text: str, at: int) -> str:
    """What stands at a place outside of a span."""
    c = text[at : at + 1] if at >= 0 else ""
    return "word" if c.isalnum() else "blank" if not c or c.isspace() else "quote" if c in "\"'" else (
        "sign" if c in "=:,;" else "joint"
    )


#: Features that tell the shape of a span.
SHAPE = ("length", "digits", "classes", "signs", "hex", "parts", "groups", "total", "distinct")


def span_features(text: str, start: int, end: int) -> list[str]:
    """Features of a whole span, of its borders and of what stands before it."""
    span = text[start:end]
    before = text[max(0, start - BEFORE) : start]
    digits = sum(c.isdigit() for c in span)
    kinds = (
        any(c.islower() for c in span),
        any(c.isupper() for c in span),
        digits > 0,
        any(not c.isalnum() for c in span),
    )
    classes = "".join("lud."[i] for i in range(4) if kinds[i])
    groups = [len(g) for g in GROUP.findall(span)] if classes in ("d", "d.") else []
    signs = "".join(sorted({c for c in span if not c.isalnum()})[:4])
    return [
        f"number {classes in ('d', 'd.')}",
        f"signs {'@' if '@' in signs else signs}",
        f"total {digits if groups else 0}",
        f"length {min(len(span), 60) // 5}",
        f"digits {10 * digits // len(span)}",
        f"classes {classes}",
        f"hex {bool(re.fullmatch('[0-9a-f]+', span)) and len(span) >= 16}",
        f"parts {min(5, len(re.findall('[A-Za-z0-9]+', span)))}",
        f"groups {'-'.join(map(str, groups[-3:]))}",
        f"distinct {10 * len(set(span)) // len(span)}",
        f"named {bool(NAMED.search(before))}",
        f"left {border(text, start - 1)}",
        f"right {border(text, end)}",
    ]


def labelled(text: str, start: int, end: int) -> tuple[str | None, tuple[str, ...]]:
    """Whether a span is a secret that training knows, and the features that must not tell so."""
    whole = border(text, start - 1) not in ("word", "joint") and border(text, end) not in ("word", "joint")
    named = whole and NAMED.search(text[max(0, start - BEFORE) : start])
    shaped = whole and KNOWN_SHAPE.fullmatch(text, start, end)
    if not (named or shaped):
        return None, ()
    # Where both tell, each of them is withheld from half of the spans.
    by_name = not shaped or named and crc32(text[start:end].encode()) % 2
    return "secret", ("named",) if by_name else SHAPE


#: What makes a phone number international.
PREFIX = re.compile(r"\+[0-9]{1,3}[\x20.-]?(?=[(0-9])")


def national(text: str) -> tuple[str, list[tuple[int, int]]]:
    """The text with its phone numbers written without country codes, and where they are then."""
    out, spans, at, shift = [], [], 0, 0
    for kind, start, end in base_spans(text):
        prefix = PREFIX.match(text, start, end) if kind == "phone" else None
        if prefix and len(DIGITS.findall(text, prefix.end(), end)) >= FEWEST_DIGITS:
            out.append(text[at:start])
            at = prefix.end()
            shift += at - start
            spans.append((at - shift, end - shift))
    return "".join([*out, text[at:]]), spans


def lattice(text: str) -> tuple[list[tuple[int, int]], list[list[str]], list[str | None]]:
    """Spans of a text with their features and kinds, to learn from: base matches and secrets, and
    phone numbers as they look without what the base rule knows them by."""
    text, phones = national(text)
    base = {(s, e): kind for kind, s, e in base_spans(text)} | dict.fromkeys(phones, "phone")
    spans = sorted({*candidates(text), *(s for s in base if s[1] - s[0] <= LONGEST)})
    features: list[list[str]] = []
    kinds: list[str | None] = []
    for start, end in spans:
        kind, withheld = base.get((start, end)), ()
        if kind is None:
            kind, withheld = labelled(text, start, end)
        kinds.append(kind)
        own = span_features(text, start, end)
        features.append([f for f in own if f.split()[0] not in withheld])
    return spans, features, kinds


def possible(text: str, start: int, end: int) -> list[bool]:
    """Which kinds a span can be of at all, whatever the weights say."""
    span = text[start:end]
    digits, letters = len(DIGITS.findall(span)), any(c.isalpha() for c in span)
    return [
        "@" in span,
        not letters and span.count(".") == 3 and len(GROUP.findall(span)) == 4,
        not letters and 13 <= digits <= 19 and luhn("".join(DIGITS.findall(span))),
        not letters and FEWEST_DIGITS <= digits <= 15,
        letters or digits < FEWEST_DIGITS,
    ]


def best_spans(spans: list[tuple[int, int]], scores: np.ndarray) -> list[tuple[int, int]]:
    """(candidate, kind) of the best set that does not overlap; ``scores`` has a row for each
    candidate and a column for each kind, and leaving a candidate out scores 0."""
    order = sorted(range(len(spans)), key=lambda i: spans[i][1])
    ends = np.array([spans[i][1] for i in order])
    best, taken = [0.0], []
    for rank, i in enumerate(order):
        kind = int(np.argmax(scores[i]))
        before = int(np.searchsorted(ends[:rank], spans[i][0], side="right"))
        gain = best[before] + float(scores[i][kind])
        taken.append((gain > best[rank], before, i, kind))
        best.append(max(gain, best[rank]))
    chosen, at = [], len(order)
    while at:
        use, before, i, kind = taken[at - 1]
        if use:
            chosen.append((i, kind))
        at = before if use else at - 1
    return chosen[::-1]


def gradient(spans: list[tuple[int, int]], scores: np.ndarray) -> np.ndarray:
    """Probability of each candidate and kind under the field, by forward and backward sums."""
    order = sorted(range(len(spans)), key=lambda i: spans[i][1])
    ends = np.array([spans[i][1] for i in order])
    n = len(order)
    before = [int(np.searchsorted(ends[:r], spans[i][0], side="right")) for r, i in enumerate(order)]
    weight = np.logaddexp.reduce(scores, axis=1)
    forward = np.zeros(n + 1)
    for r, i in enumerate(order):
        forward[r + 1] = np.logaddexp(forward[r], forward[before[r]] + weight[i])
    backward = np.full(n + 1, -np.inf)
    backward[n] = 0.0
    for r in range(n - 1, -1, -1):
        backward[r] = np.logaddexp(backward[r], backward[r + 1])
        at = before[r]
        backward[at] = np.logaddexp(backward[at], backward[r + 1] + weight[order[r]])
    out = np.zeros_like(scores)
    for r, i in enumerate(order):
        out[i] = np.exp(forward[before[r]] + scores[i] + backward[r + 1] - forward[n])
    return out


class Field:
    """Weights of (feature, kind)."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights

    def scores(self, features: list[list[str]]) -> np.ndarray:
        unseen = np.zeros(len(KINDS))
        rows = [sum((self.weights.get(f, unseen) for f in fs), np.zeros(len(KINDS))) for fs in features]
        return np.array(rows).reshape(-1, len(KINDS)) - (0.0 if self.weights else np.inf)


def train(samples: list[tuple[list, list, list]]) -> Field:
    """Maximum likelihood by gradient steps, lightly pulled to zero."""
    names = sorted({f for _, features, _ in samples for fs in features for f in fs})
    number = {f: i for i, f in enumerate(names)}
    weights = np.zeros((len(names), len(KINDS)))
    scale = np.full_like(weights, 1e-6)
    prepared = []
    for spans, features, kinds in samples:
        seen = np.zeros((len(spans), len(names)))
        for row, fs in enumerate(features):
            seen[row, [number[f] for f in fs]] = 1
        right = np.zeros((len(spans), len(KINDS)))
        for row, kind in enumerate(kinds):
            if kind:
                right[row, KINDS.index(kind)] = 1
        prepared.append((spans, seen, right))
    for _ in range(EPOCHS):
        step = -0.01 * weights
        for spans, seen, right in prepared:
            step += seen.T @ (right - gradient(spans, seen @ weights))
        scale += step**2
        weights += 0.5 * step / np.sqrt(scale)
    return Field({f: weights[i] for f, i in number.items()})


def fit(docs: DataFrame, training_texts: int = TRAINING_TEXTS) -> Field:
    """A field trained on about ``training_texts`` of the texts that have candidates, chosen by a
    hash. Only features of their spans come to the driver."""
    rows = Positions(docs).pick("text").filter("text is not null")

    def has(text: str) -> bool:
        return "@" in text or DIGITS.search(text) is not None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(has(text.as_py()) for batch in batches for text in batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64())], names=["n"])

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lattice(t.as_py()) for t in batch.column(0) if has(t.as_py())]
            lines = sorted({json.dumps(f) for f in found if f[0]})
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["line"])

    unit = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    # Texts with candidates are counted on a part of the texts, chosen by another hash.
    share = min(1.0, 20_000 / max(1, rows.count()))
    part = rows.filter(F.pmod(F.xxhash64(F.lit("part"), "text"), F.lit(1 << 20)) < share * (1 << 20))
    seen = part.mapInArrow(count, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] / share
    chosen = rows.filter(unit < min(1.0, training_texts / max(1.0, seen)) * (1 << 40))
    lines = sorted(r[0] for r in chosen.mapInArrow(sample, "line string").distinct().collect())
    return train([tuple(json.loads(line)) for line in lines])


def apart(spans: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans that touch none of those ``taken``, which are joined first and then searched."""
    starts, ends = [], []
    for start, end in sorted(taken):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    # The first joined span that ends behind the start of a span is the only one it can touch first.
    at = [bisect_right(ends, start) for start, _ in spans]
    return [s for s, k in zip(spans, at, strict=True) if k == len(starts) or starts[k] >= s[1]]


def find(text: str | None, field: Field) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: the base ones and what the field adds beside them."""
    text = text or ""
    base = base_spans(text)
    spans = apart(candidates(text), [(s, e) for _, s, e in base])
    added = []
    if spans:
        scores = field.scores([span_features(text, s, e) for s, e in spans]) - MARGIN
        scores[~np.array([possible(text, s, e) for s, e in spans])] = -np.inf
        added = [(KINDS[k], *spans[i]) for i, k in best_spans(spans, scores)]
    return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def detect(docs: DataFrame, field: Field) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, n_added, base_sha256, spans) of every row of
    ``docs(doc_id, text)``.

    Spans are kind:start:end in code points, end exclusive, by kind and start; the counts of kinds
    are those of the base rules, ``n_added`` counts what the field adds. A null text is an empty
    one: counts 0, no spans. Texts of any length are scanned whole, in time that grows with their
    length. Repeated rows are judged alike; an empty table gives no rows.
    """
    rows = Positions(docs).pick("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1):
                base, spans = find(text.as_py(), field)
                seen = Counter(kind for kind, *_ in base)
                digest = sha256(written(base).encode()).hexdigest()
                counts = (*[seen[k] for k in BASE], len(spans) - len(base))
                out.append((*counts, digest, written(spans)))
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            kinds = [pa.int64()] * (len(BASE) + 1) + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                names=["doc_id", *names],
            )

    names = [*[f"n_{k}" for k in BASE], "n_added", "base_sha256", "spans"]
    counts = ", ".join(f"{name} long" for name in names[:-2])
    doc_type = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {doc_type}, {counts}, base_sha256 string, spans string")


def masked(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with its columns, each span of ``text`` replaced by its kind in brackets."""
    given = Positions(docs)
    at = given.names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [mask(text.as_py(), field) for text in batch.column(at)]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return given.restore(given.rows.mapInArrow(run, given.rows.schema))


def mask(text: str | None, field: Field) -> str | None:
    """Overlapping spans become one, of the kind that starts first."""
    if text is None:
        return None
    out, at = [], 0
    for kind, start, end in sorted(find(text, field)[1], key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
