"""Operators on pages, conversations and embeddings, and their registered queries."""

import random
import time
from collections import Counter
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import chat_format, embedding_dedup, graph, html_extraction, queries

from .conftest import SMALLEST

TABLES = "documents embeddings pages benchmark labels conversations".split()


# --- pages

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">a</a><li><a href="/b">b</a></ul></nav>
<div id="cookie-notice">We use cookies on all pages of this site for you</div>
<ARTICLE data-x='a > b'><h1>Head &amp; line</h1><p>First pa<b>ra</b> of   the text.<br>Line two&hellip;
<aside><p>Aside words that are many, many, many, many more than one</aside>
<p class="advert">Buy now<p>Second &eacute;t&#233; para.<!-- no > --><script>if (a < b) x("</p>")</script></ARTICLE>
<section class="comments"><article><p>I like this one a lot, thanks</article></section>
<form><label>Mail</label><button>Send</button></form><footer>&copy; us</footer></body></html>"""


def test_page_text_is_the_article_alone():
    text = html_extraction.main_text(PAGE, {})
    assert text == "Head & line First para of the text. Line two… Second été para."


def test_page_without_an_article_loses_its_frame():
    page = PAGE.replace("ARTICLE", "div")
    page = page.replace('<section class="comments"><article>', '<section class="comments">')
    assert html_extraction.main_text(page, {}).startswith("Head & line First para")
    assert "thanks" not in html_extraction.main_text(page, {})


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain words", "plain words"),
        ("<p>cut <b", "cut"),
        ("<script>never closed <p>x", ""),
        ("<article><p>a < b & c &am</article>", "a < b & c &am"),
        ("<nav>only a menu</nav>", ""),
        ("<article>" + "<p>x " * 20_000, ("x " * 20_000).strip()),
    ],
)
def test_odd_pages(html, text):
    assert html_extraction.main_text(html, {}) == text


def test_many_unmatched_end_tags_and_open_elements_take_linear_time():
    deep = "<article>" + "<div>" * 40_000 + "text" + "</section></b>" * 40_000 + "</article>"
    started = time.monotonic()
    assert html_extraction.main_text(deep, {}) == "text"
    assert time.monotonic() - started < 20


def test_best_region_against_all_regions(spark):
    random.seed(5)
    weights = {"word article": 2.0, "tag p unmarked": -1.5, "tag div unmarked": -4.0}
    for _ in range(100):
        html = "".join(random.choice(["<p>", "<div>", "</div>", "w ", "w w w ", "<i>"]) for _ in range(25))
        page = html_extraction.tokens(html)
        score = [n * html_extraction.weight(f, weights) for f, n in map(html_extraction.features, page)]
        best = max((sum(score[a:b]) for a in range(len(page)) for b in range(a, len(page) + 1)), default=0)
        start, end = html_extraction.region(page, weights)
        assert abs(sum(score[start:end]) - max(best, 0)) < 1e-9


def test_pages_as_a_table(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html_extraction.extract(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in found) == [(0, 0), (1, 62), (1, 62)]
    assert html_extraction.extract(pages.limit(0)).count() == 0


def test_given_pages_lose_nothing_of_their_article(spark):
    import re
    from html import unescape

    pages = spark.read.parquet(f"{SMALLEST}/pages.parquet")
    found = {r.page_id: r.text for r in html_extraction.extract(pages).collect()}
    for row in pages.collect():
        article = re.search("<article>(.*?)</article>", row.html, re.S)[1]
        plain = re.sub("<[^>]+>", " ", article.replace("<b>", ""))
        assert found[row.page_id] == " ".join(unescape(plain).split())


def test_given_pages_without_their_marks_give_the_same_article(spark):
    import re

    pages = spark.read.parquet(f"{SMALLEST}/pages.parquet")
    weights = html_extraction.fit(pages)
    shared, found, wanted = 0, 0, 0
    for row in pages.collect():
        bare = re.sub(r"<(/?)(article|nav|footer|aside|header)\b[^>]*>", r"<\1div>", row.html)
        bare = bare.replace('class="ad"', 'class="x"')
        got = html_extraction.main_text(bare, weights).split()
        right = html_extraction.main_text(row.html, weights).split()
        found, wanted = found + len(got), wanted + len(right)
        shared += sum((Counter(got) & Counter(right)).values())
    assert shared >= 0.99 * wanted and shared >= 0.99 * found


# --- conversations

SCRAPS = [*"<s> </s> [INST] [/INST] <<SYS>> <</SYS>> [SEP] [ROLE] [TEXT] [/ROLE] </ s> <\\s>".split()]
SCRAPS += ["\\", "<", "[", "\n", "a é 😀", " ", "[\\\\SEP]"]


def test_conversations_are_read_back(spark):
    random.seed(3)
    rows = []
    for conv in range(40):
        for turn in range(random.randint(1, 7)):
            role = random.choice(["user", "assistant", "system", "tool", "[SEP]", "", None])
            text = random.choice([None, "".join(random.choices(SCRAPS, k=random.randint(0, 9)))])
            rows.append((conv, turn, role, text, "x"))
    rows += [(99, t, "assistant", f"turn {t}", "x") for t in range(3000)]
    turns = spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, segments string"
    ).repartition(5)
    made = {r.conv_id: r for r in chat_format.formatted(turns).collect()}
    read = {r.conv_id: r for r in chat_format.read_back(chat_format.formatted(turns)).collect()}
    for conv in {r[0] for r in rows}:
        own = [(role or "", text or "") for c, _, role, text, _ in rows if c == conv]
        said = "".join(f"{role}\n{text}\n" for role, text in own)
        loss = "".join(text for role, text in own if role == "assistant")
        assert read[conv].n_turns == len(own)
        assert read[conv].turns_sha256 == sha256(said.encode()).hexdigest()
        assert read[conv].loss_chars == len(loss)
        assert read[conv].loss_sha256 == sha256(loss.encode()).hexdigest()
        assert read[conv].formatted_chars == len(made[conv].formatted)
        assert "".join(s.text for s in made[conv].segments) == made[conv].formatted


def test_ties_and_nulls_in_conversations(spark):
    rows = [(None, None, "user", "b"), (None, None, "user", "a"), (None, 1, None, None), (1, 1, "user", "c"), (1, 1, "user", "c")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = {r.conv_id: r.formatted for r in chat_format.formatted(turns).collect()}
    assert made == {
        None: "[INST]a[SEP]b[/INST][ROLE][TEXT][/ROLE]",
        1: "[INST]c[SEP]c[/INST]",
    }
    assert chat_format.formatted(turns.limit(0)).count() == 0


# --- embeddings


def brute_links(rows, cosine=0.98):
    units = []
    for i, (vec_id, vector, label) in enumerate(rows):
        if label is not None and vector and None not in vector:
            v = np.array(vector, np.float32).astype(float)
            if np.isfinite(v).all() and v.any():
                units.append((i, label, v / np.linalg.norm(v)))
    links = {i: set() for i in range(len(rows))}
    for i, a, u in units:
        for j, b, v in units:
            if i != j and a == b and len(u) == len(v) and u @ v >= cosine:
                links[i].add(j)
    component = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        component[i] = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
    return sorted(
        (repr(rows[i][0]), len(links[i]), repr(component[i]), rows[i][0] is not None and rows[i][0] == component[i])
        for i in links
    )


def check_embeddings(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    recalls = []
    frame = frame.withColumn("node", F.lit("x")).withColumn("size", F.lit(None).cast("string"))
    found = embedding_dedup.near_duplicates(frame, report=recalls.append).collect()
    got = sorted((repr(r.vec_id), r.n_links, repr(r.component_id), r.kept) for r in found)
    assert got == brute_links(rows)
    return recalls


def test_dense_groups_chains_and_copies(spark):
    rng = np.random.default_rng(1)
    rows = []
    for k in range(400):
        rows.append((len(rows), rng.normal(size=16).tolist(), k % 2))
    centre = rng.normal(size=16)
    for _ in range(700):  # more than two tiles, with many distances around the limit
        rows.append((len(rows), (centre + 0.12 * rng.normal(size=16)).tolist(), 1))
    at = rng.normal(size=16)
    for _ in range(60):  # a chain
        at = at / np.linalg.norm(at) + 0.03 * rng.normal(size=16)
        rows.append((len(rows), at.tolist(), 0))
    rows += [(len(rows) + i, rows[5][1], 1) for i in range(50)]
    rows += [(len(rows) + i, [2.0 * x for x in rows[7][1]], rows[7][2]) for i in range(3)]
    assert check_embeddings(spark, rows)[-1] >= embedding_dedup.RECALL


def test_links_between_two_tight_groups(spark):
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(size=32).tolist(), 1) for k in range(60)]
    for across in (0.985, 0.975):  # just above the limit, and just below it
        one, two = np.linalg.qr(rng.normal(size=(32, 2)))[0].T
        for centre in (one, across * one + np.sqrt(1 - across**2) * two):
            for _ in range(10):
                rows.append((len(rows), (centre + 0.001 * rng.normal(size=32)).tolist(), 1))
    assert sorted({n for _, n, _, _ in brute_links(rows)}) == [0, 9, 19]
    check_embeddings(spark, rows)


def test_lost_small_groups_are_seen_beside_a_large_one(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(0, rng.normal(size=16).tolist(), 1)] * 4000
    rows += [(1 + k, [x + 0.01 * rng.normal() for x in rows[0][1]], 1) for k in range(12)]
    for k in range(20):
        at = rng.normal(size=16)
        rows += [(1000 + 2 * k + i, (at + 0.005 * i).tolist(), 1) for i in range(2)]
    whole, recalls = embedding_dedup.neighbour_lists, []

    def only_large(classes, *others):
        large = classes.filter("first_id < 1000").select(F.col("node").alias("u"))
        return whole(classes, *others).join(large, "u", "left_semi")

    monkeypatch.setattr(embedding_dedup, "neighbour_lists", only_large)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = embedding_dedup.near_duplicates(frame, report=recalls.append).collect()
    pairs = {r.vec_id: (r.n_links, r.component_id) for r in found if r.vec_id >= 1000}
    assert pairs == {k: (1, k // 2 * 2) for k in range(1000, 1040)}
    assert recalls[0] < embedding_dedup.RECALL


def test_crowded_leaves_are_split_around_their_mean(spark):
    rng = np.random.default_rng(8)
    common = 3 * rng.normal(size=16)
    rows = [(k, (common + rng.normal(size=16)).tolist(), 1) for k in range(1000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    classes, kind = embedding_dedup.classes_of(frame)
    leaves = classes.select("node", "family", F.lit(0).alias("tree"), F.lit(0).cast("long").alias("leaf"))
    crowded = embedding_dedup.crowded_leaves(leaves)
    split = embedding_dedup.split_leaves(leaves, crowded, classes, kind, 0).collect()
    sizes = [len([r for r in split if r.leaf == leaf]) for leaf in {r.leaf for r in split}]
    nodes = sorted(r.node for r in classes.select("node").collect())
    assert sorted(r.node for r in split) == nodes and len(set(nodes)) == 1000 and max(sizes) < 500


def test_one_id_of_several_vectors_and_labels(spark):
    rng = np.random.default_rng(3)
    one, other, third = (rng.normal(size=8) for _ in range(3))
    rows = [(1, one.tolist(), 1), (1, other.tolist(), 1), (1, third.tolist(), 2)]
    rows += [(2, (one + 0.001).tolist(), 1), (3, (other + 0.001).tolist(), 1), (0, (third + 0.001).tolist(), 2)]
    check_embeddings(spark, rows)
    rows += [(k % 7, (one + 0.05 * k * rng.normal(size=8)).tolist(), k % 3) for k in range(60)] * 2
    check_embeddings(spark, rows)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(frame).count() == len(rows)


def test_odd_vectors(spark):
    one, nan, inf = [1.0, 0.0, 0.5], float("nan"), float("inf")
    rows = [
        (1, one, 1), (2, one, None), (3, None, 1), (4, [], 1), (5, [0.0, -0.0, 0.0], 1),
        (6, [1.0, nan, 0.0], 1), (7, [inf, 0.0, 0.0], 1), (8, [1.0, None, 0.0], 1), (9, one, 1),
        (9, one, 1), (None, one, 1), (10, [1.0, 0.0], 1), (11, [1.0, -0.0, 0.5], 1),
        (12, [3e38, 0.0, 1.5e38], 1), (13, [1e-40, 0.0, 5e-41], 1), (None, [1.0, 1.0], 2),
    ]
    check_embeddings(spark, rows)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(empty).count() == 0


def test_components_of_random_graphs(spark):
    random.seed(9)
    for nodes, edges in [(1, 0), (200, 150), (300, 600), (500, 499)]:
        chain = edges == 499
        pairs = [(i, i + 1) if chain else tuple(random.choices(range(nodes), k=2)) for i in range(edges)]
        frame = spark.createDataFrame([*pairs, (None, 1)], "a long, b long")
        found = {r.node: r.component for r in graph.components(frame).collect()}
        parent = {n: n for p in pairs if p[0] != p[1] for n in p}

        def root(n, parent=parent):
            while parent[n] != n:
                n = parent[n]
            return n

        for a, b in pairs:
            if a != b:
                parent[max(root(a), root(b))] = min(root(a), root(b))
        assert found == {n: root(n) for n in parent}


# --- registered queries


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{SMALLEST}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, duck, name):
    found = queries.QUERIES[name](spark, SMALLEST)
    wanted = duck.execute(queries.SQL[name])
    names = [column[0] for column in wanted.description]
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(repr, map(tuple, found.select(names).collect()))) == sorted(map(repr, wanted.fetchall()))


def test_pipeline_works_on_all_that_the_stage_before_kept(spark, tmp_path):
    import corpus_pipeline
    from orderloom.llm import mixing, quality_rules, simhash_dedup

    docs = spark.read.parquet(f"{SMALLEST}/documents.parquet")
    kept = {}
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, SMALLEST)
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = sorted(r.doc_id for r in docs.collect())
    first = spark.read.parquet(f"{SMALLEST}/documents.parquet")
    good = quality_rules.quality(first).filter("kept")
    assert kept["quality rules"] == kept["line dedup"] == sorted(r.doc_id for r in good.collect())
    lines = spark.read.parquet(f"{tmp_path}/line dedup")
    single = simhash_dedup.near_duplicates(lines).filter("doc_id = component_id")
    assert kept["simhash near-dedup"] == sorted(r.doc_id for r in single.collect())
    drawn = mixing.replication(spark.read.parquet(f"{tmp_path}/simhash near-dedup"))
    assert kept["source mixing"] == sorted(r.doc_id for r in drawn.collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALLEST)
    assert packed.filter("start = 0").count() == docs.count()
    assert corpus_pipeline.run(spark, SMALLEST).count() == packed.count()
