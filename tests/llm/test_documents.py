"""Operators on documents, against brute force."""

import collections
import random
import re
from hashlib import sha256
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderloom.llm import (
    cutting_stock,
    language_id,
    line_dedup,
    mixing,
    packing,
    pii,
    quality_rules,
    simhash_dedup,
    word_tokens,
)

from .conftest import SMALLEST

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Nulls, blanks, repeated rows and a long text.
ODD = [
    (1, None, "a"),
    (2, "", None),
    (None, " \n\t", "a"),
    (None, "one two three four five six seven eight nine ten eleven", "b"),
    (3, "same same", "a"),
    (3, "same same", "a"),
    (4, "word " * 30_000, "a"),
    (5, "é" * 5_000, "b"),
]


def rows_of(frame, *names):
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)


# --- quality rules


def brute_repeats(text, window=5):
    words = WORD.findall(text)
    covered, longest = set(), 0
    for size in range(window, len(words)):
        seen = collections.Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
        starts = [i for i in range(len(words) - size + 1) if seen[tuple(words[i : i + size])] > 1]
        if not starts:
            break
        longest = size
        if size == window:
            covered = {i + k for i in starts for k in range(window)}
    return len(words), len(covered), longest


def test_repeats_against_brute_force():
    random.seed(4)
    texts = []
    for _ in range(300):
        letters = "abcdefgh"[: random.choice([1, 2, 3, 8])]
        texts.append(" ".join(random.choices(letters, k=random.randint(0, 70))))
    for text, found in zip(texts, quality_rules.measure(texts, 5, 200), strict=True):
        assert (found[0], found[4], found[5]) == brute_repeats(text), text


def test_a_long_repeat_is_only_known_to_be_over_the_limit_and_covered_whole():
    text = " ".join(f"w{i}" for i in range(500))
    measured = quality_rules.measure([f"{text} {text}"], 5, 40)[0]
    assert measured[4] == 1000 and measured[5] > 40


def test_the_longest_repeat_alone_decides(make_documents):
    def text(n_words, repeat, name):
        words = [f"{name}{i}" for i in range(n_words - repeat)]
        return " ".join(words + words[:repeat])

    sizes = [(400, 30), (400, 31), (400, 39), (2000, 100), (2000, 101), (2000, 190), (60_000, 3001), (60_000, 3000)]
    rows = [(i, text(n, r, "w"), "a") for i, (n, r) in enumerate(sizes)]
    found = {r.doc_id: r for r in quality_rules.quality(make_documents(rows)).collect()}
    assert not any(r.base_failed for r in found.values())
    assert [found[i].kept for i in range(8)] == [True, False, False, True, False, False, False, True]
    assert [found[i].longest_repeat for i in range(8)] == [30, 31, 31, 100, 101, 101, 3001, 3000]
    alone = quality_rules.quality(make_documents(rows[1:2])).first()
    assert alone.asDict() == found[1].asDict()


def test_measures_of_lines_and_characters(make_documents):
    text = "a line\nb # line\na line\n \n \na  line"
    row = quality_rules.quality(make_documents([(1, text, "a")])).first()
    assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines) == (9, 21, 1, 1)


def test_quality_of_odd_rows(make_documents, spark):
    docs = make_documents(ODD)
    found = {(r.doc_id, r.n_words): r.kept for r in quality_rules.quality(docs).collect()}
    assert found[1, 0] is False and found[None, 11] is True and found[4, 30_000] is False
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.collect()] == [None]
    assert quality_rules.quality(docs.limit(0)).count() == 0
    assert quality_rules.keep_good(docs.limit(0)).count() == 0


# --- SimHash


def brute_fingerprint(text):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, links):
    label = dict.fromkeys(prints)
    parent = {i: i for i in label}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: root(i) for i in label}


def test_near_duplicates_against_brute_force(documents):
    found = {r.doc_id: r for r in simhash_dedup.near_duplicates(documents).collect()}
    prints = {r.doc_id: brute_fingerprint(r.text) for r in documents.collect()}
    assert {i: r.fingerprint % (1 << 64) for i, r in found.items()} == prints
    ids = sorted(prints)
    links = [
        (a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2
    ]
    assert {i: r.component_id for i, r in found.items()} == brute_components(prints, links)


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_links_of_any_radius_connect_the_same(spark, bits):
    random.seed(bits)
    base = [random.getrandbits(63) for _ in range(12)]
    prints = {p ^ sum(1 << b for b in random.sample(range(63), k)) for p in base for k in range(4)}
    frame = spark.createDataFrame([(p,) for p in sorted(prints)], "fingerprint long")
    edges = [(r.a, r.b) for r in simhash_dedup.links(frame, bits).collect()]
    assert all((a ^ b).bit_count() <= bits for a, b in edges)
    close = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= bits]
    assert brute_components(prints, edges) == brute_components(prints, close)


def test_one_of_each_group_stays(make_documents):
    text = " ".join(f"w{i}" for i in range(200))
    docs = make_documents(
        [(7, text, "a"), (5, text.upper(), "b"), (5, text.upper(), "b"), (9, "other text here", "a"), (None, "x y", "a")]
    )
    kept = simhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id") == [(5,), (9,), (None,)]
    assert simhash_dedup.keep_one(docs.limit(0)).count() == 0


def test_near_duplicates_of_odd_rows(make_documents):
    found = simhash_dedup.near_duplicates(make_documents(ODD))
    got = rows_of(found, "doc_id", "component_id")
    assert len(got) == len(ODD) and (1, 1) in got and (2, 1) in got and (None, 1) in got


# --- line dedup

LINE = "this line is common to many sites"


def test_boilerplate_goes_but_for_its_first_occurrence(make_documents):
    rows = [(i, f"own text number {i} goes here\n{LINE} \nmore of number {i} here", f"s{i}") for i in range(8)]
    docs = make_documents([*rows, (20, None, "s1"), (21, "", None), (None, rows[0][1], None)])
    found = line_dedup.remove_boilerplate(docs)
    assert found.columns == docs.columns
    texts = {r.doc_id: r.text for r in found.collect()}
    assert texts[0] == rows[0][1]
    assert texts[3] == "own text number 3 goes here\nmore of number 3 here"
    assert texts[20] is None and texts[21] == "" and LINE not in texts[None]
    assert line_dedup.remove_boilerplate(docs.limit(0)).count() == 0


def brute_lines(rows, min_sites=5, full_chars=25):
    """Texts without boilerplate, by (doc_id, text)."""
    blanks = "\x20\x09\x0a\x0b\x0c\x0d"
    sites, first = collections.defaultdict(set), {}
    every = {source for _, _, source in rows if source is not None}
    for doc_id, text, source in rows:
        for n, raw in enumerate((text or "").split("\n")):
            line = raw.strip(blanks)
            sites[line].add(source)
            body = xxhash.xxh64_intdigest((text or "").encode(), 42)
            place = (doc_id is None, doc_id or 0, body - (body >> 63 << 64), n)
            first[line] = min(first.get(line, place), place)
    cut = {}
    for doc_id, text, _ in rows:
        body = xxhash.xxh64_intdigest((text or "").encode(), 42)
        left = []
        for n, raw in enumerate((text or "").split("\n")):
            line = raw.strip(blanks)
            needed = max(min_sites, min(len(every), -(-min_sites * full_chars // max(len(line), 1))))
            is_first = first[line] == (doc_id is None, doc_id or 0, body - (body >> 63 << 64), n)
            if not line or is_first or len(sites[line] - {None}) < needed:
                left.append(raw)
        cut[doc_id, text] = None if text is None else "\n".join(left)
    return cut


def test_lines_of_every_length_and_whole_copies_against_brute_force(make_documents):
    random.seed(12)
    few = [(i, f"{LINE}\nsome more of text {i} for here", f"s{i % 4}") for i in range(40)]
    short = [(100 + i, f"Subscribe now\nown words of text {i} are here", f"s{i}") for i in range(20)]
    short += [(130 + i, f"All rights reserved. \nown {i}\n\tShare\n---", f"s{i}") for i in range(14)]
    copies = [(200 + i, "a whole text that was copied\nas it stands to all the sites", f"s{i}") for i in range(9)]
    mixed = []
    for i in range(300, 500):
        lines = [random.choice(["x", "ok", "Menu", "Read more", "Contact us", "a line of all the mixed texts", "", f"own {i}"]) for _ in range(9)]
        mixed.append((i, "\n".join(lines), random.choice([None, *[f"s{k}" for k in range(22)]])))
    odd = [(None, LINE, "s1"), (None, LINE, "s2"), (7, None, "s3"), (8, "", "s1"), (8, " \n \n", "s1"), (300, "Menu", "s1")]
    rows = [*few, *short, *copies, *mixed, *odd]
    want = brute_lines(rows)
    found = line_dedup.remove_boilerplate(make_documents(rows)).collect()
    got = sorted((repr(r.doc_id), r.text or "") for r in found)
    assert got == sorted((repr(i), want[i, text] or "") for i, text, _ in rows)
    texts = {r.doc_id: r.text for r in found}
    assert texts[5] == LINE + "\nsome more of text 5 for here"
    assert [texts[200], texts[208]] == ["a whole text that was copied\nas it stands to all the sites", ""]
    assert texts[140] == "own 10\n\tShare\n---" and "Subscribe" not in texts[110]


def test_one_very_long_text_of_lines(make_documents):
    line = "one and the same line of a long text"
    rows = [(i, "\n".join([line] * (20_000 if i == 3 else 2)), f"s{i}") for i in range(6)]
    found = {r.doc_id: r.text for r in line_dedup.remove_boilerplate(make_documents(rows)).collect()}
    assert found == {0: line} | dict.fromkeys(range(1, 6), "")


def test_spread_near_the_limit_is_exact(make_documents):
    rows = []
    for k in range(60):
        line = f"line {k} that stands on a number of sites"
        rows += [
            (1000 * k + i, f"{line}\nonly here {k} {i} and not somewhere else {'x' * 20}", f"s{i}")
            for i in range(3 + k % 5)
        ]
    found = {r.doc_id: r.text for r in line_dedup.remove_boilerplate(make_documents(rows)).collect()}
    for doc_id, text, _ in rows:
        spread = 3 + doc_id // 1000 % 5
        gone = spread >= line_dedup.MIN_SITES and doc_id % 1000 > 0
        assert (found[doc_id] != text) == gone


# --- mixing


def test_poisson_counts_follow_the_rates(spark, make_documents):
    docs = make_documents(
        [(i, f"text {i}", s) for i, s in enumerate(["a"] * 3000 + ["b"] * 1000 + [None] * 500)]
    )
    weights = spark.createDataFrame([("a", 0.25), ("b", 0.75)], "source string, weight double")
    found = collections.Counter(
        r.source for r in mixing.mix(docs, weights=weights, total=8000.0).collect()
    )
    assert found[None] == 0
    assert abs(found["a"] - 2000) < 5 * 2000**0.5 and abs(found["b"] - 6000) < 5 * 6000**0.5


def test_large_rates_are_several_draws(spark, make_documents):
    docs = make_documents([(i, "t", "a") for i in range(100)])
    found = mixing.mix(docs, total=100 * 300.0)
    assert found.columns == docs.columns
    assert abs(found.count() - 30_000) < 5 * 30_000**0.5


def test_mixture_is_repeatable_and_shuffled(make_documents):
    docs = make_documents([(i, f"t{i}", f"s{i % 3}") for i in range(400)])
    first = [r.doc_id for r in mixing.mix(docs).collect()]
    assert first == [r.doc_id for r in mixing.mix(docs.repartition(3)).collect()]
    assert first != sorted(first)
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(make_documents(ODD)).columns == docs.columns


# --- packing


def check_packing(packed, docs, length=packing.LENGTH):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    wanted = collections.Counter()
    for row in docs.collect():
        ids = tokenizer.encode(row.text or "", add_special_tokens=False).ids
        wanted[row.doc_id, np.array([*ids, 1], "<u4").tobytes()] += 1
    pieces = packed.collect()
    total = sum(len(ids) // 4 * n for (_, ids), n in wanted.items())
    assert sum(p.length for p in pieces) == total
    by_id = collections.defaultdict(list)
    for p in pieces:
        by_id[p.doc_id].append(p)
    for (doc_id, ids), n in wanted.items():
        own = [p for p in by_id[doc_id] if p.doc_tokens * 4 == len(ids)]
        for p in own:
            assert any(
                crc32(i[4 * p.start : 4 * (p.start + p.length)]) == p.ids_crc32
                for d, i in wanted
                if d == doc_id
            )
        assert len(own) % n == 0 and own
    spans = collections.defaultdict(list)
    for p in pieces:
        spans[p.sequence_id].append((p.offset, p.length))
    for places in spans.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= length
    return 1 - total / (length * len(spans))


def test_packing_holds_every_id_with_little_padding(documents):
    docs = documents.select("doc_id", "text")
    packed = packing.pack(docs, TOKENIZER).cache()
    assert check_packing(packed, docs) < 0.02
    sequences = packing.sequences(docs, packed, TOKENIZER)
    sizes = {r.sequence_id: r.n for r in packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()}
    assert {r.sequence_id: len(r.ids) for r in sequences.collect()} == sizes


def test_packing_of_odd_rows(make_documents):
    docs = make_documents(ODD)
    check_packing(packing.pack(docs, TOKENIZER), docs)
    assert packing.pack(docs.limit(0), TOKENIZER).count() == 0


@pytest.mark.parametrize("sizes", [[1], [2], [9], list(range(1, 31)), list(range(1, 101)), list(range(1, 1025))])
def test_padding_of_short_and_mixed_pieces(sizes):
    rng = np.random.default_rng(len(sizes))
    pieces = rng.choice(sizes, 100_000)
    sizes, demand = np.unique(pieces, return_counts=True)
    of_size = cutting_stock.classes(sizes, demand)
    classes, number = np.unique(of_size, return_inverse=True)
    assert (of_size >= sizes).all() and len(classes) <= cutting_stock.CLASSES
    chosen = cutting_stock.cut(classes, np.bincount(number, demand).astype(np.int64), 2048)
    bound = -(-int(demand @ sizes) // 2048)
    assert sum(n for n, _ in chosen) <= 1.02 * bound + 1


def test_classes_waste_little_and_keep_the_largest():
    sizes, demand = np.arange(1, 41), np.full(40, 10)
    demand[[6, 30]] = 100_000
    joined = cutting_stock.classes(sizes, demand, 10)
    assert set(np.unique(joined)) >= {7, 31, 40} and len(np.unique(joined)) == 10
    assert cutting_stock.classes(sizes, demand, 40).tolist() == sizes.tolist()
    assert cutting_stock.classes(sizes[:0], demand[:0]).tolist() == []


@pytest.mark.parametrize(("text", "times"), [("a b", 5000), ("", 3000), ("one two three four five", 700)])
def test_packing_of_equal_short_documents(spark, text, times):
    docs = spark.range(times).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    packed = packing.pack(docs, TOKENIZER)
    found = packed.agg(F.sum("length").alias("n"), F.count_distinct("sequence_id").alias("used")).first()
    assert packed.count() == times and found.used <= 1.02 * -(-found.n // 2048) + 1


def test_packing_joins_sizes_into_classes(spark, monkeypatch):
    joined = cutting_stock.classes
    monkeypatch.setattr(packing, "classes", lambda sizes, demand: joined(sizes, demand, 3))
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"), F.expr("repeat('word ', cast(id % 40 as int))").alias("text")
    )
    assert check_packing(packing.pack(docs, TOKENIZER), docs) < 0.5


def test_patterns_meet_the_demand_exactly():
    random.seed(8)
    for _ in range(20):
        sizes = np.array(sorted(random.sample(range(1, 65), random.randint(1, 20))), np.int64)
        demand = np.array([random.randint(1, 200) for _ in sizes], np.int64)
        chosen = cutting_stock.cut(sizes, demand, 64)
        assert (sum(n * p for n, p in chosen) == demand).all()
        assert all(p @ sizes <= 64 for _, p in chosen)
        bound = -(-int(demand @ sizes) // 64)
        # The bound cannot be met where sizes over half a sequence leave gaps.
        if sizes[-1] <= 16:
            assert sum(n for n, _ in chosen) <= 1.05 * bound + 2


def test_word_ids_equal_the_tokenizer(documents):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    words = word_tokens.WordIds(TOKENIZER)
    texts = [r.text for r in documents.collect()] + [
        "It's <|endoftext|> they'LL 've x\x1cy",
        "ÀÉÎ ﬁ ΑΣ Σ é 日本語 😀 don't!!! 3.14 a\x00b   Iİ",
        "x" * 5000,
    ]
    for text in texts:
        want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert words.encode(text) == want


# --- language


def test_languages_of_held_out_texts(spark, documents):
    labelled = documents.filter("doc_id % 3 <> 0").select("text", "lang")
    model = language_id.fit(labelled)
    found = language_id.identify(documents.filter("doc_id % 3 = 0"), model)
    right = found.join(documents.select("doc_id", "lang"), "doc_id")
    n = right.count()
    assert right.filter("lang = lang_pred").count() >= 0.95 * n
    assert right.filter("score < 0 or score > 1").count() == 0


def test_a_mixture_of_two_languages_is_seen(documents):
    model = language_id.fit(documents.select("text", "lang"))
    texts = {}
    for row in documents.collect():
        if len(row.text) > 2000:
            texts.setdefault(row.lang, row.text[:2000])
    found = language_id.languages_of(texts["de"] + " " + texts["fr"], model)
    assert set(found) == {"de", "fr"} and all(p > 0.3 for p in found.values())


def test_language_of_odd_rows(make_documents, documents):
    model = language_id.fit(documents.select("text", "lang"))
    docs = make_documents([*ODD, (9, "123 ... !", "a")])
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs, model).collect()}
    assert found[1] == found[2] == found[9] == ("und", 0.0)
    assert language_id.identify(docs.limit(0), model).count() == 0
    nothing = language_id.fit(docs.limit(0).select("text", "lang"))
    assert language_id.languages_of("some text", nothing) == {}


def test_long_texts_are_counted_in_blocks(monkeypatch):
    text = "Über den Wolken, là où le ciel est bleu. " * 50
    whole = language_id.cells(text)
    monkeypatch.setattr(language_id, "BLOCK", 64)
    parts = language_id.cells(text)
    assert abs(parts[1].sum() - whole[1].sum()) <= len(text) / 64 * 3


# --- personal data

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    found = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((kind, *m.span()))
    return found


def test_base_spans_against_the_rules(documents):
    random.seed(6)
    bits = ["1", "23", "4.5.6.7", "255", ".", "@", "a", "b.c", "-", " ", "+1 ", "4111111111111111"]
    bits += ["555-2485", "é", "a@b.c", "(988)", "300.1.1.1", "\n", "%", "_"]
    texts = ["".join(random.choices(bits, k=random.randint(0, 12))) for _ in range(20_000)]
    texts += [r.text for r in documents.collect()]
    for text in texts:
        assert pii.base_spans(text) == brute_spans(text), text


def test_detection_keeps_base_spans_and_adds_secrets(spark, make_documents):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    field = pii.fit(docs)
    for row in pii.detect(docs, field).join(docs.select("doc_id", "text"), "doc_id").collect():
        base = brute_spans(row.text)
        written = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert row.base_sha256 == sha256(written.encode()).hexdigest()
        assert set(filter(None, written.split(","))) <= set(row.spans.split(","))
        assert row.n_email == sum(k == "email" for k, *_ in base)
    added = 'set token = "1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae" here'
    masked = pii.masked(make_documents([(1, added, "a"), (2, None, "a"), (3, "b@c.de", "a")]), field)
    assert rows_of(masked, "doc_id", "text") == [
        (1, 'set token = "[secret]" here'),
        (2, None),
        (3, "[email]"),
    ]
    assert pii.detect(docs.limit(0), field).count() == 0
    assert pii.find("a1" * 10, pii.fit(docs.limit(0)))[1] == []


@pytest.fixture(scope="module")
def learned(spark):
    return pii.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


@pytest.mark.parametrize(
    ("text", "added"),
    [
        ("call (017) 555-7713 or write", ["phone (017) 555-7713"]),
        ("call 017 555 7713 today", ["phone 017 555 7713"]),
        ("his password: hunter2 was seen", ["secret hunter2"]),
        ("api_key=correcthorsebatterystaple\n", ["secret correcthorsebatterystaple"]),
        ('token = "' + "5e1fA9" * 40 + '" in the log', ["secret " + "5e1fA9" * 40]),
        ("on 2024-05-17 12:30 it was 3.141592653 or 1234567890123 in all", []),
        ("see https://example.com/path/to/some-page-2024.html and internationalisation", []),
        ("id 550e8400-e29b-41d4-a716-446655440000 of chapter 12, 13, 14, 15, 16, 17 and 18", []),
        ("call +1 (017) 555-7713 or a@b.org", []),
    ],
)
def test_the_field_chooses_borders_and_kinds(learned, text, added):
    base, spans = pii.find(text, learned)
    assert base == pii.base_spans(text)
    assert [f"{kind} {text[s:e]}" for kind, s, e in spans if (kind, s, e) not in base] == added


def test_runs_offer_several_borders_a_bounded_number_from_each_start():
    assert pii.candidates("(0172) 555-77134-5678 x") == [(0, 16), (0, 21), (7, 21), (11, 21)]
    found = [t[s:e] for t in ["xy/AKIAABCDEFGHIJ12/ab"] for s, e in pii.candidates(t)]
    assert "AKIAABCDEFGHIJ12" in found and "xy/AKIAABCDEFGHIJ12" in found
    long = "12 34 56 78 " * 5_000 + "ab1/" * 5_000
    assert len(pii.candidates(long)) < 12 * 30_000


def test_training_hides_what_the_labels_were_made_of(documents):
    text = 'token = "1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae" and +1 (017) 555-7713 end'
    spans, features, kinds = pii.lattice(text)
    told = {kind: {f.split()[0] for f in own} for kind, own in zip(kinds, features, strict=True) if kind}
    assert set(told) == {"secret", "phone"}
    assert ("named" in told["secret"]) != ("hex" in told["secret"])
    assert pii.national(text)[0].endswith("and (017) 555-7713 end")


def test_candidates_apart_from_base_spans():
    random.seed(5)
    for _ in range(500):
        spans = sorted((a, a + random.randint(1, 9)) for a in random.choices(range(60), k=6))
        taken = [(a, a + random.randint(1, 9)) for a in random.choices(range(60), k=random.randrange(5))]
        apart = [s for s in spans if not any(s[0] < e and b < s[1] for b, e in taken)]
        assert pii.apart(spans, taken) == apart
    text = "mail a1@b2.de or key 1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae " * 20_000
    assert len(pii.find(text, pii.Field({}))[0]) == 20_000


def test_field_probabilities_match_enumeration():
    rng = np.random.default_rng(2)
    spans = [(0, 3), (2, 5), (4, 8), (5, 9), (9, 12)]
    scores = rng.normal(size=(len(spans), len(pii.KINDS)))
    total, seen, best = 0.0, np.zeros_like(scores), (-1e9, None)
    kinds = range(len(pii.KINDS) + 1)
    for choice in np.ndindex(*[len(kinds)] * len(spans)):
        chosen = [(i, k - 1) for i, k in enumerate(choice) if k]
        if any(
            spans[a][0] < spans[b][1] and spans[b][0] < spans[a][1]
            for a, _ in chosen
            for b, _ in chosen
            if a < b
        ):
            continue
        score = sum(scores[c] for c in chosen)
        total += np.exp(score)
        for c in chosen:
            seen[c] += np.exp(score)
        best = max(best, (score, chosen), key=lambda x: x[0])
    assert np.allclose(pii.gradient(spans, scores), seen / total)
    assert sorted(pii.best_spans(spans, scores)) == best[1]


def test_pipeline_stages_take_odd_rows_and_empty_tables(spark, make_documents):
    import corpus_pipeline
    from orderloom.llm.work import stage

    text = " ".join(f"own{i}" for i in range(40))
    rows = [*ODD, (9, text, "a"), (9, text, "a"), (10, text + " more", None), (None, f"{text} x y z", "b")]
    for docs in (make_documents(rows), make_documents(rows).limit(0)):
        columns, current = docs.columns, docs
        for _, function in corpus_pipeline.STAGES[:-1]:
            current = stage(function(spark, current, SMALLEST), "odd-stage")
            assert current.columns == columns
        packed = corpus_pipeline.STAGES[-1][1](spark, current, SMALLEST)
        assert packed.filter("start = 0").count() == current.count()
    kept = corpus_pipeline.quality(spark, make_documents(rows), SMALLEST)
    assert sorted(repr(r.doc_id) for r in kept.collect()) == ["10", "9", "9", "None", "None"]
