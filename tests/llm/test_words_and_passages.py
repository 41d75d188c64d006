"""Spelling variants, the prefix trie and repeated passages, against brute force."""

import random
import re
from collections import Counter, defaultdict
from hashlib import sha256
from math import fmod
from zlib import crc32

import duckdb
import pytest
from pyspark.sql import functions as F

from orderloom.llm import prefix_trie, queries, spelling_variants, substring_dedup

from .conftest import SMALLEST

NEW = ["op11_spelling_variants", "op12_prefix_trie", "op13_substring_dedup"]


def in_order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("name", NEW)
def test_registered_queries_match_sql(spark, name):
    got = queries.QUERIES[name](spark, SMALLEST)
    duck = duckdb.connect()
    for table in ("documents", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALLEST}/{table}.parquet'")
    cursor = duck.execute(queries.SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(got.columns)
    assert in_order(map(tuple, got.select(names).collect())) == in_order(cursor.fetchall())


# --- repeated passages


def brute_kept(rows):
    """(n_words, n_removed, kept) of each (doc_id, text)."""
    docs = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    owner = {}
    for i, words in docs:
        for s in range(len(words) - 49) if i is not None else ():
            content = tuple(words[s : s + 50])
            owner[content] = min(owner.get(content, i), i)
    for i, words in docs:
        gone = set()
        for s in range(len(words) - 49) if i is not None else ():
            if owner[tuple(words[s : s + 50])] < i:
                gone.update(range(s, s + 50))
        yield len(words), len(gone), " ".join(w for p, w in enumerate(words) if p not in gone)


def check_passages(frame):
    rows = frame.collect()
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.remove_repeats(frame).collect()]
    want = brute_kept([(r.doc_id, r.text) for r in rows])
    assert in_order(got) == in_order((r.doc_id, *w) for r, w in zip(rows, want, strict=True))
    return got


def mixed_documents():
    random.seed(11)

    def prose(n):
        return [f"w{random.randrange(5000)}" for _ in range(n)]

    passages = [prose(n) for n in (49, 50, 51, 75, 140, 400)]
    rows = []
    for doc_id in range(60):
        parts = []
        for _ in range(random.randrange(4)):
            passage = random.choice(passages)
            start = random.randrange(0, 20) if len(passage) > 100 else 0
            parts += [prose(random.randrange(30)), passage[start : len(passage) - random.randrange(3)]]
        rows.append((doc_id, [w for part in parts for w in part]))
    rows.append((100, rows[5][1]))
    near = list(rows[7][1] or prose(80))
    near[len(near) // 2] = "changed"
    rows += [(101, near), (3, passages[5]), (3, passages[4]), (None, passages[5]), (-1, passages[3])]
    return [(i, random.choice(" \n\t\r").join(words), "s") for i, words in rows]


def test_passages_of_earlier_documents_go(make_documents):
    got = check_passages(make_documents(mixed_documents()))
    assert sum(r[2] for r in got) > 1000


def test_passages_with_few_shards_and_crowded_phrases(make_documents, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", 2000)
    monkeypatch.setattr(substring_dedup, "GROUP_PIECES", 2)
    check_passages(make_documents(mixed_documents()))


def test_constant_texts_copies_and_odd_rows(make_documents):
    same = "the " * 3000
    rows = [(9, same, "a"), (4, "the " * 60, "a"), (5, "the " * 49, "b"), (6, "a b " * 700, None)]
    rows += [(7, "b a " * 40 + "x", "a"), (8, None, "a"), (8, "", "a"), (None, same, "a")]
    rows += [(10, "é ü " * 80, "a"), (11, "é ü\x1f " * 80, "a"), (12, "é ü " * 70, "a")]
    rows += [(20 + i, " ".join(f"c{j}" for j in range(130)), "b") for i in range(50)] * 2
    frame = make_documents(rows)
    got = check_passages(frame)
    assert {r[2] for r in got if r[0] == 9} == {3000}
    made = substring_dedup.remove_repeats(frame.withColumn("shard", F.lit("x")))
    assert set(frame.columns) | {"shard", "n_words", "n_removed", "kept_text"} == set(made.columns)
    assert made.filter("shard = 'x' and kept = 'x'").count() == len(rows)
    assert substring_dedup.remove_repeats(frame.limit(0)).count() == 0


def test_a_very_long_text_loses_one_passage(make_documents):
    words = [f"v{i}" for i in range(120_000)]
    rows = [(2, " ".join(words), "a"), (1, " ".join(words[70_000:70_120]), "b")]
    got = {r[0]: r for r in check_passages(make_documents(rows))}
    assert (got[2][1], got[2][2], got[1][2]) == (120_000, 120, 0)


def test_least_place_against_a_plain_search():
    import numpy as np

    random.seed(2)
    for width in (1, 2, 3, 7, 35):
        values = np.array([random.randrange(6) for _ in range(90)], np.uint64)
        plain = [min(range(i, i + width), key=lambda j: (values[j], j)) for i in range(91 - width)]
        assert substring_dedup.least(values, width).tolist() == plain


# --- spelling variants


def brute_near(words):
    """Words of a dict at one edit, by trying all edits over the letters that occur."""
    alphabet = sorted({c for w in words for c in w})
    near = defaultdict(set)
    for w in words:
        edits = {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in alphabet}
        edits |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in ["", *alphabet]}
        near[w] = {e for e in edits if e in words and e != w}
    return near


def brute_variants(words, ratio=5):
    near, form = brute_near(words), {}
    for w, n in words.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-words[x], x))
            if words[best] >= ratio * n:
                form[w] = best
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        yield w, form.get(w), root, n, len(near[w]), words.get(form.get(w))


def random_words():
    random.seed(8)
    words = {}
    for _ in range(500):
        word = "".join(random.choices("abé", k=random.randint(4, 8)))
        words[word] = random.choice([5, 6, 30, 31, 200, 1200, 7000])
    words |= {"aaaaaaaa": 9, "aaaaaaaaa": 90, "aaaaaaaaaa": 900, "abcdef": 5, "abcxef": 25, "bbcdef": 25}
    return words


def test_variants_against_all_edits(spark):
    words = random_words()
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = spelling_variants.variants(frame).collect()
    assert in_order(map(tuple, got)) == in_order(brute_variants(words))
    assert any(r.root != r.form for r in got if r.form)


def test_variants_of_few_odd_words(spark):
    rows = [("abc", 9), ("abd", 90), ("word" * 500, 5), ("word" * 500 + "s", 50), (None, 7), ("same", 2), ("same", 3)]
    frame = spark.createDataFrame(rows, "word string, n long")
    got = {r.word: (r.form, r.n, r.n_near) for r in spelling_variants.variants(frame).collect()}
    assert got["word" * 500] == ("word" * 500 + "s", 5, 1)
    assert got["abc"] == (None, 9, 0) and got["same"] == (None, 5, 0) and got[None] == (None, 7, 0)
    assert spelling_variants.variants(frame.limit(0)).count() == 0


def test_pivots_against_all_choices():
    random.seed(4)
    for _ in range(300):
        size = random.randint(3, 9)
        places = sorted(random.sample(range(12), size))
        cost = [random.randrange(9) for _ in places]
        pairs = [(cost[i] + cost[j], i, j) for i in range(size) for j in range(size) if places[i] + 2 <= places[j]]
        left, right = spelling_variants.pivots(places, cost)
        assert cost[places.index(left)] + cost[places.index(right)] == min(pairs)[0] and left + 2 <= right


def test_runs_are_counted_and_damaged(make_documents):
    rows = [(i, "Straße ÉCOLE école Éco÷le naïve-garçons don't ABCDEF abcdef", "s") for i in range(400)]
    rows += [(None, "abcdef " * 9, "s"), (7, None, "s"), (8, "", "s")]
    got = dict(map(tuple, spelling_variants.word_counts(make_documents(rows), 199).collect()))
    want = Counter()
    for i, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            drawn = crc32(f"{i}:{run}".encode())
            if i is not None and drawn % 199 == 0:
                run = run[: drawn % len(run)] + run[drawn % len(run) + 1 :]
            want[run] += 1
    assert got == {w: n for w, n in want.items() if len(w) >= 6 and n >= 5}
    assert spelling_variants.word_counts(make_documents(rows).limit(0)).count() == 0


# --- prefix trie

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
LEADER = "conv_id - conv_id % 100"
BORROWED = "cast(crc32(cast(cast(conv_id as string) as binary)) % 6 as int)"


def brute_trie(rows):
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        digest = sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()
        given[conv].append(((turn is not None, turn or 0), digest, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in given.items()}
    members, ends, children, total = defaultdict(list), defaultdict(list), defaultdict(list), {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 6
        path = own.get(c - int(fmod(c, 100)), [])[:h] + turns[h:]
        for depth in range(len(path) + 1):
            members[tuple(path[:depth])].append(c)
        ends[tuple(path)].append(c)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        below = [total[child] for child in children[node]]
        total[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    for node, found in members.items():
        parent = min(members[node[:-1]]) if node else None
        ids = ",".join(map(str, sorted(ends[node])))
        yield (
            min(found),
            len(node),
            parent,
            len(found),
            len(children[node]),
            *total[node],
            sha256(ids.encode()).hexdigest(),
        )


def conversations():
    random.seed(6)
    rows = []
    for conv in [*range(230), -7, -100, -150, 5_000_000_007]:
        for turn in range(random.randint(1, 9)):
            text = random.choice([None, "", "yes", "no 😀", "a longer answer " * 3])
            rows.append((conv, turn, random.choice(["user", "assistant", None]), text))
    rows += [(300, t, "user", f"turn {t}") for t in range(1500)]
    rows += [(c, t, "user", f"turn {t}") for c in range(301, 340) for t in range(40)]
    rows += [(350, None, "user", "b"), (350, None, "user", "a"), (350, 1, "user", "c"), (350, 1, "user", "c")]
    return rows


@pytest.mark.parametrize(("shard", "queue"), [(20_000, 200_000), (60, 5), (1, 1)])
def test_trie_against_brute_force(spark, shard, queue):
    rows = conversations()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    paths = prefix_trie.prefixes(prefix_trie.turn_digests(frame), LEADER, BORROWED)
    got = prefix_trie.trie(paths, shard, queue).select(NODE).collect()
    assert in_order(map(tuple, got)) == in_order(brute_trie(rows))


def test_trie_of_plain_conversations(spark):
    rows = [(1, 0, "user", "a", "x"), (1, 1, "user", "b", "x"), (2, 0, "user", "a", "x"), (2, 0, "user", "a", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key string")
    made = prefix_trie.trie(prefix_trie.prefixes(prefix_trie.turn_digests(frame))).select(NODE[:7])
    assert in_order(map(tuple, made.collect())) == [
        (1, 0, None, 2, 1, 2, 1),
        (1, 1, 1, 2, 2, 2, 1),
        (1, 2, 1, 1, 0, 1, 0),
        (2, 2, 1, 1, 0, 1, 0),
    ]
    empty = prefix_trie.prefixes(prefix_trie.turn_digests(frame.limit(0)))
    assert prefix_trie.trie(empty).count() == 0


def test_role_and_text_do_not_run_together(spark):
    rows = [(1, 0, "user", "1:x"), (2, 0, "user1", ":x"), (3, 0, "use", "r1:x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert prefix_trie.turn_digests(frame).select("digest").distinct().count() == 3


def test_queue_spills_and_keeps_the_order():
    random.seed(1)
    queue, messages = prefix_trie.SpillingQueue(4), [(random.randrange(20), i) for i in range(300)]
    for message in messages:
        queue.push(message)
    assert len(queue.files) > 10
    popped = [m for priority in range(20) for m in sorted(queue.pop_all((priority,)))]
    assert popped == sorted(messages)
