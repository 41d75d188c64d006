"""Removal of passages that stand in an earlier document, found with repeated-phrase automata.

Every window of 50 consecutive words holds one *phrase*: the run of 16 words whose hash is least in
the window (the leftmost of equal ones). Equal windows hold equal phrases, so only windows around a
phrase of several documents can recur, and one word in about 18 starts a phrase.

1. Phrases of all documents are counted by hash; those of two documents or more are confirmed.
2. Documents are dealt into shards of bounded size. Each shard compiles an Aho-Corasick automaton
   of its confirmed phrases, one letter a word, and streams its documents through it. The windows
   around a located phrase form a *piece*; copies of a piece are collapsed before they move on.
3. All different pieces around one phrase meet, and each of their windows finds the smallest
   document that holds it. Pieces of a very frequent phrase are dealt out by window.
4. Ranges of words go back to the documents, whose remaining words are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderloom.llm.work import Positions, discard, few, stage

#: Consecutive words that make a passage.
WINDOW = 50
#: Words of a phrase; longer ones are rarer by chance, shorter ones are fewer a window.
PHRASE = 16
#: Text bytes of a shard: what its documents and its automaton need follows from it.
SHARD_BYTES = 32 << 20
#: Tasks that the shards are dealt to at most; each takes one shard after another.
MAX_TASKS = 100_000
#: Pieces around one phrase that one task compares at once.
GROUP_PIECES = 20_000
#: Windows that a task compares at once, over whole phrases.
BATCH_WINDOWS = 500_000

#: An odd factor has an inverse modulo 2^64, which makes sums of powers rolling hashes.
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


class _Powers:
    """Powers of a factor modulo 2^64, as many as the longest text so far needed."""

    def __init__(self, factor: int):
        self.factor, self.known = np.uint64(factor), np.ones(1, np.uint64)

    def first(self, n: int) -> np.ndarray:
        while len(self.known) < n:
            step = self.known[-1] * self.factor
            self.known = np.concatenate([self.known, self.known * step])
        return self.known[:n]


_UP, _DOWN = _Powers(_FACTOR), _Powers(_INVERSE)


def mixed(values: np.ndarray) -> np.ndarray:
    """Values whose order and low bits say nothing about their source."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of each word; bytes split at the blanks 0x20 and 0x09 to 0x0D alone."""
    from xxhash import xxh3_64_intdigest

    words = text.split()
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def sums(words: np.ndarray) -> np.ndarray:
    """Running sums from which ``spans`` takes the hash of any span."""
    with np.errstate(over="ignore"):
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _UP.first(len(words)))])


def spans(running: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` consecutive words."""
    with np.errstate(over="ignore"):
        plain = running[length:] - running[:-length]
        return mixed(plain * _DOWN.first(len(plain)))


def least(values: np.ndarray, width: int) -> np.ndarray:
    """For every ``width`` consecutive values, the place of the least; the leftmost of equals."""

    def better(left, right):
        return np.where(values[left] <= values[right], left, right)

    best, covered = np.arange(len(values)), 1
    while covered * 2 <= width:
        best = better(best[: len(best) - covered], best[covered:])
        covered *= 2
    rest = width - covered
    return better(best[: len(best) - rest], best[rest:]) if rest else best


def phrases(running: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the phrase that starts at each word, and the phrase place of each window."""
    hashes = spans(running, PHRASE)
    return hashes, least(hashes, WINDOW - PHRASE + 1)


def distinct(places: np.ndarray) -> np.ndarray:
    """Each of the places of successive windows once; they never go back."""
    return places[np.diff(places, prepend=-1) != 0]


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def letters(words: np.ndarray) -> str:
    """A text of one letter a word, for the automaton; different words seldom share a letter."""
    code = (words % np.uint64(0xD7FF)).astype(np.uint32) + np.uint32(1)
    return code.tobytes().decode("utf-32-le")


def _utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary()).to_pylist()


def _phrase_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, docs, shards = [], [], []
        rows = zip(
            batch.column("doc").to_pylist(),
            batch.column("shard").to_pylist(),
            _utf8(batch.column("text")),
            strict=True,
        )
        for doc, shard, text in rows:
            words = word_hashes(text)
            if len(words) < WINDOW:
                continue
            hashes, places = phrases(sums(words))
            own = np.unique(hashes[distinct(places)])
            found.append(own)
            docs.append(np.full(len(own), doc, np.int64))
            shards.append(np.full(len(own), shard, np.int32))
        if found:
            yield pa.record_batch(
                [np.concatenate(found).view(np.int64), np.concatenate(docs), np.concatenate(shards)],
                names=["phrase", "doc", "shard"],
            )


def _pieces_of(words: np.ndarray, automaton) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first window, phrase, hashes of its windows) of each piece of one document."""
    located = np.zeros(len(words), bool)
    for end, _ in automaton.iter(letters(words)):
        located[end - PHRASE + 1] = True
    if not located.any():
        return
    running = sums(words)
    hashes, places = phrases(running)
    windows = spans(running, WINDOW)
    chosen = np.flatnonzero(located[places])
    if not len(chosen):
        return
    apart = (np.diff(chosen) != 1) | (np.diff(places[chosen]) != 0)
    for run in np.split(chosen, np.flatnonzero(apart) + 1):
        yield int(run[0]), int(hashes[places[run[0]]].view(np.int64)), windows[run].view(np.int64)


def _shard_pieces(confirmed: list[np.ndarray], docs: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Pieces of the documents of one shard, located by its automaton."""
    import ahocorasick
    from xxhash import xxh3_128_digest

    wanted = np.unique(np.concatenate(confirmed)) if confirmed else np.empty(0, np.int64)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    spelled = []
    for doc, text_hash, text in docs:
        words = word_hashes(text)
        if len(words) < WINDOW:
            continue
        hashes, places = phrases(sums(words))
        places = distinct(places)
        places = places[among(hashes[places].view(np.int64), wanted)]
        if len(places):
            text = letters(words)
            for place in places.tolist():
                automaton.add_word(text[place : place + PHRASE])
            spelled.append((doc, text_hash, words))
    if not spelled:
        return
    automaton.make_automaton()
    columns: list[list] = [[] for _ in range(6)]
    for doc, text_hash, words in spelled:
        for first, phrase, windows in _pieces_of(words, automaton):
            piece = xxh3_128_digest(windows.tobytes())
            for column, value in zip(columns, (doc, text_hash, first, phrase, piece, windows), strict=True):
                column.append(value)
        if len(columns[0]) > 20_000:
            yield _piece_batch(columns)
            columns = [[] for _ in range(6)]
    if columns[0]:
        yield _piece_batch(columns)


def _piece_batch(columns: list[list]) -> pa.RecordBatch:
    sizes = np.cumsum([0] + [len(windows) for windows in columns[5]]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(columns[5])))
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    made = [pa.array(column, kind) for column, kind in zip(columns[:5], kinds, strict=True)]
    return pa.record_batch([*made, lists], names=["doc", "text_hash", "start", "phrase", "piece", "windows"])


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shard after shard: first its confirmed phrases, then its documents."""
    shard, confirmed, docs = None, [], []
    for batch in batches:
        numbers = batch.column("shard").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for start, end in zip(edges, edges[1:], strict=False):
            if start == end:
                continue
            if numbers[start] != shard:
                yield from _shard_pieces(confirmed, docs)
                shard, confirmed, docs = numbers[start], [], []
            part = batch.slice(start, end - start)
            found = part.column("phrase").drop_null()
            if len(found):
                confirmed.append(found.to_numpy(zero_copy_only=False))
            if len(found) < len(part):
                rows = part.slice(len(found))
                keys = zip(rows.column("doc").to_pylist(), rows.column("text_hash").to_pylist(), strict=True)
                for key, text in zip(keys, _utf8(rows.column("text")), strict=True):
                    # Repeated rows stand side by side; one of them is enough.
                    if not docs or docs[-1][:2] != key:
                        docs.append((*key, text))
    yield from _shard_pieces(confirmed, docs)


def _owned(rows: pa.Table) -> pa.RecordBatch:
    """Runs of windows of each piece with the smallest document that holds them."""
    lists = rows.column("windows").combine_chunks()
    piece = lists.value_parent_indices().to_numpy(zero_copy_only=False)
    window = lists.flatten().to_numpy(zero_copy_only=False)
    offset = np.arange(len(piece)) - np.searchsorted(piece, piece)
    parts = rows.column("parts").to_numpy()[piece]
    own = np.mod(window, parts) == rows.column("part").to_numpy()[piece]
    piece, window, offset = piece[own], window[own], offset[own]
    phrase = rows.column("phrase").to_numpy()[piece]
    doc = rows.column("doc").to_numpy()[piece]
    order = np.lexsort((doc, window, phrase))
    first = np.ones(len(order), bool)
    first[1:] = (np.diff(phrase[order]) != 0) | (np.diff(window[order]) != 0)
    owner = np.empty(len(order), np.int64)
    owner[order] = doc[order][np.flatnonzero(first)][np.cumsum(first) - 1]
    taken = owner < rows.column("last_doc").to_numpy()[piece]
    piece, offset, owner = piece[taken], offset[taken], owner[taken]
    breaks = np.ones(len(piece), bool)
    breaks[1:] = (np.diff(piece) != 0) | (np.diff(offset) != 1) | (np.diff(owner) != 0)
    starts = np.flatnonzero(breaks)
    ends = np.append(starts[1:], len(piece))[: len(starts)] - 1
    return pa.record_batch(
        [
            rows.column("piece").combine_chunks().take(pa.array(piece[starts])),
            offset[starts].astype(np.int32),
            offset[ends].astype(np.int32),
            owner[starts],
        ],
        names=["piece", "first", "last", "owner"],
    )


def _owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_owned`` over whole phrases, as many at once as their windows allow."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        count += len(batch.column("windows").flatten())
        held.append(batch)
        if count < BATCH_WINDOWS:
            continue
        rows = pa.Table.from_batches(held)
        phrase, part = rows.column("phrase").to_numpy(), rows.column("part").to_numpy()
        other = np.flatnonzero((phrase != phrase[-1]) | (part != part[-1]))
        whole = int(other[-1]) + 1 if len(other) else 0
        if whole:
            yield _owned(rows.slice(0, whole))
            held = rows.slice(whole).combine_chunks().to_batches()
            count = sum(len(rest.column("windows").flatten()) for rest in held)
    if held:
        yield _owned(pa.Table.from_batches(held))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, texts = [], [], []
        rows = zip(_utf8(batch.column("text")), batch.column("ranges").to_pylist(), strict=True)
        for text, ranges in rows:
            words = (text or b"").split()
            n_words.append(len(words))
            if ranges:
                change = np.zeros(len(words) + 1, np.int64)
                for span in ranges:
                    change[span["start"]] += 1
                    change[span["end"]] -= 1
                stays = np.cumsum(change)[:-1] == 0
                words = [words[i] for i in np.flatnonzero(stays).tolist()]
            n_removed.append(n_words[-1] - len(words))
            texts.append(b" ".join(words))
        others = [n for n in batch.schema.names if n not in ("text", "ranges")]
        made = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
        made.append(pa.array(texts, pa.binary()).cast(pa.string()))
        yield pa.record_batch(
            [*[batch.column(n) for n in others], *made],
            names=[*others, "n_words", "n_removed", "kept_text"],
        )


def shard_count(docs: DataFrame) -> int:
    """How many shards the texts fill."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return size // SHARD_BYTES + 1


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(doc, text_hash, ranges) of the documents that lose words; ``docs`` has doc, text_hash, text.

    ``ranges`` are the spans ``[start, end)`` of words that belong to a window whose words also
    stand in a document with a smaller ``doc``.
    """
    shards = shard_count(docs)
    place = F.pmod(F.xxhash64("doc", "text_hash"), F.lit(shards))
    placed = docs.withColumn("shard", place.cast("int"))
    counted = (
        placed.select("doc", "shard", "text")
        .mapInArrow(_phrase_rows, "phrase long, doc long, shard int")
        .groupBy("phrase")
        .agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.collect_set("shard").alias("shards"))
    )
    confirmed = counted.filter("low < high").select("phrase", F.explode("shards").alias("shard"))
    both = confirmed.select(
        "shard", "phrase", *[F.lit(None).cast(t).alias(n) for n, t in _DOC_COLUMNS]
    ).unionByName(placed.withColumn("phrase", F.lit(None).cast("long")))
    tasks = min(shards, MAX_TASKS)
    pieces = stage(
        both.repartitionById(tasks, F.col("shard") % tasks)
        .sortWithinPartitions("shard", F.col("phrase").asc_nulls_last(), "doc", "text_hash")
        .mapInArrow(
            _locate,
            "doc long, text_hash long, start int, phrase long, piece binary, windows array<long>",
        ),
        "phrase-pieces",
    )
    different = stage(
        pieces.groupBy("phrase", "piece", "windows").agg(
            F.min("doc").alias("doc"), F.max("doc").alias("last_doc")
        ),
        "different-pieces",
    )
    crowded = stage(
        different.groupBy("phrase")
        .agg(F.ceil(F.count(F.lit(1)) / GROUP_PIECES).alias("parts"))
        .filter("parts > 1"),
        "crowded-phrases",
    )
    residues = F.array_distinct(F.transform("windows", lambda w: F.pmod(w, F.col("parts"))))
    dealt = (
        different.join(few(crowded), "phrase", "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)).cast("long"))
        .withColumn(
            "part",
            F.explode(F.when(F.col("parts") == 1, F.array(F.lit(0).cast("long"))).otherwise(residues)),
        )
    )
    owners = stage(
        dealt.repartition("phrase", "part")
        .sortWithinPartitions("phrase", "part")
        .select("phrase", "part", "parts", "piece", "windows", "doc", "last_doc")
        .mapInArrow(_owners, "piece binary, first int, last int, owner long"),
        "window-owners",
    )
    ranges = stage(
        pieces.select("piece", "doc", "text_hash", "start")
        .join(owners, "piece")
        .filter("owner < doc")
        .groupBy("doc", "text_hash")
        .agg(
            F.collect_set(
                F.struct(
                    (F.col("start") + F.col("first")).alias("start"),
                    (F.col("start") + F.col("last") + WINDOW).alias("end"),
                )
            ).alias("ranges")
        ),
        "repeated-ranges",
    )
    for used in (pieces, different, crowded, owners):
        discard(used)
    return ranges


_DOC_COLUMNS = (("doc", "long"), ("text_hash", "long"), ("text", "string"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Every document with ``n_words``, ``n_removed`` and ``kept_text``, all other columns as given.

    Words are runs of anything but the blanks 0x20 and 0x09 to 0x0D. A word goes if a window of 50
    words that covers it has the same words as a window of a document with a smaller ``doc_id``;
    all windows are judged as given. What is kept is joined by one space.

    A null text has no words. A null ``doc_id`` is neither smaller nor larger than another: such a
    row loses nothing and takes nothing away. Rows of one ``doc_id`` leave each other alone, and
    so do passages repeated inside one document only. Repeated rows stay and get equal results.
    Texts of fewer than 50 words are joined unchanged; one task holds one text of any length.
    An empty table gives no rows. Columns named like the new ones are replaced.
    """
    given = docs.drop("n_words", "n_removed", "kept_text")
    rows = Positions(given)
    narrow = rows.pick("doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("text_hash"), "text"
    )
    ranges = repeated_ranges(narrow.filter("doc is not null and text is not null"))
    joined = rows.rows.withColumn("doc", rows["doc_id"].cast("long")).withColumn(
        "text_hash", F.xxhash64(rows["text"])
    )
    joined = joined.join(ranges, ["doc", "text_hash"], "left").withColumn("text", rows["text"])
    made = StructType([*rows.rows.schema.fields])
    for name, kind in (("n_words", "long"), ("n_removed", "long"), ("kept_text", "string")):
        made = made.add(name, kind)
    return (
        joined.select(*rows.inner, "text", "ranges")
        .mapInArrow(_kept, made)
        .toDF(*given.columns, "n_words", "n_removed", "kept_text")
    )
