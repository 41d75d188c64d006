"""Main text of web pages by the maximum-scoring subsequence of their tokens.

A page is a sequence of words and tags. Words score positive and tags negative, words inside
parts that are never an article score negative too; a linear scan finds the contiguous region with
the largest sum. The weights are log odds counted on labelled pages: those with an ``article`` or
``main`` element, whose inside is the label. Pages without one are scored by what every page has:
tag names, the block and the link a word stands in, and the words of the block.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.work import Positions

#: Labelled pages that the weights are counted on, about; the first by a hash of the page.
TRAINING_PAGES = 4_000

# Element names with a meaning of their own.
RAW = {"script", "style", "title", "textarea", "iframe", "noscript", "xmp"}
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "source"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "img", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub",
    "sup", "time", "tt", "u", "var", "wbr",
}
ARTICLE = {"article", "main"}
ASIDE = {
    "aside", "button", "canvas", "datalist", "dialog", "fieldset", "footer", "form", "head",
    "header", "menu", "nav", "object", "select", "svg", "template", "video", "audio",
}
ASIDE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb",
    "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright",
    "disclaimer", "discussion", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pager",
    "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "reply",
    "respond", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor",
    "sponsored", "subscribe", "toolbar", "widget",
}
ASIDE_ROLES = {
    "alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu",
    "menubar", "navigation", "search", "toolbar",
}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*+)"
    r"(?P<attributes>(?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(
    r"([A-Za-z_:][\w:.-]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?", re.S
)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
#: Elements that matter only if their attributes say so; their end tags are often left out.
LIGHT = INLINE | {"p", "li"}
#: Before such a name, an attribute speaks of what an element has, not of what it is.
HAVING = {"has", "with", "no", "without", "hide", "show"}

#: Where a word stands: in an article, in a part that is never one, elsewhere on a page that has
#: an article, on a page that has none.
IN_ARTICLE, IN_ASIDE, BESIDE, UNMARKED = "article", "aside", "beside", "unmarked"
#: Score of a word or tag that no labelled page has shown, and the least that a tag costs.
WORD, TAG, LEAST = 1.0, 0.5, 0.05
#: A feature that every page has weighs at most this much for or against.
MOST = 2.0
#: Blocks that say nothing of their content; those of the label are among them.
PLAIN = ARTICLE | {"body", "div", "html", "section", ""}
#: Words of a block up to which it is of one size.
SIZES = (3, 9, 24)


class Token:
    """A run of text with its place, or a tag (``name`` is set). ``shape`` is what a run shows
    whatever its place: its block, whether it is in a link, and the size of the block."""

    __slots__ = ("name", "text", "words", "place", "breaks", "closes", "shape")

    def __init__(self, name: str, text: str, place: str, breaks: bool, closes: bool = False):
        self.name, self.text, self.place, self.breaks = name, text, place, breaks
        self.closes = closes
        self.words = len(text.split())
        self.shape = ""


def is_aside(name: str, attributes: str) -> bool:
    """Whether an element is a part that is never the article, by its name or attributes."""
    if name in ASIDE:
        return True
    if name in ARTICLE or name in ("html", "body") or not attributes.strip("/ \n"):
        return False
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), values[0] or values[1] or values[2]
        if key in ("class", "id"):
            for word in value.split():
                parts = [p.lower() for p in PART.findall(word)]
                if not HAVING.intersection(parts) and ASIDE_NAMES.intersection(parts):
                    return True
        if key == "role" and value.lower() in ASIDE_ROLES:
            return True
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "style" and HIDDEN.search(value):
            return True
    return False


def tokens(html: str) -> list[Token]:
    """The page as text runs and tags. Elements left open end with the one around them; open
    inline elements and paragraphs also end at the next block."""
    found: list[Token] = []
    stack: list[tuple[str, str]] = []  # name, and what the element is: a place or ""
    # How many elements are open of each place, and of each name: an end tag without one is passed by.
    inside, opened = Counter(), Counter()
    at, size = 0, len(html)

    def leave(depth: int) -> None:
        while len(stack) > depth:
            name, kind = stack.pop()
            inside[kind] -= 1
            opened[name] -= 1

    def place() -> str:
        return next((p for p in (IN_ASIDE, "article", "main") if inside[p]), BESIDE)

    while at < size:
        match = TOKEN.search(html, at)
        end = match.start() if match else size
        if end > at:
            found.append(Token("", unescape(html[at:end]), place(), False))
        if not match:
            break
        at = match.end()
        if not match["name"]:
            continue
        name, block = match["name"].lower(), match["name"].lower() not in INLINE
        while block and stack and stack[-1][0] in INLINE:
            leave(len(stack) - 1)
        if match["close"]:
            found.append(Token(name, "", place(), block, True))
            if opened[name]:
                leave(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
            continue
        if stack and (stack[-1][0] == "p" and block or stack[-1][0] == name == "li"):
            leave(len(stack) - 1)
        found.append(Token(name, "", place(), block))
        attributes = match["attributes"]
        if name in RAW:
            closing = RAW_END[name].search(html, at)
            at = closing.end() if closing else size
        elif name not in VOID and not attributes.endswith("/"):
            kind = IN_ASIDE if is_aside(name, attributes) else name if name in ARTICLE else ""
            if kind or name not in LIGHT:
                stack.append((name, kind))
                inside[kind] += 1
                opened[name] += 1
    # An article counts before the main element around it; without either, any text may do.
    marked = next((k for k in ("article", "main") if any(t.place == k and t.words for t in found)), "")
    for token in found:
        if token.place != IN_ASIDE:
            token.place = UNMARKED if not marked else IN_ARTICLE if token.place == marked else BESIDE
    set_shapes(found)
    return found


def set_shapes(page: list[Token]) -> None:
    """Give each text run of a page its shape."""
    open_blocks, link, run = [""], False, []
    opened = Counter()

    def close() -> str:
        opened[open_blocks[-1]] -= 1
        return open_blocks.pop()

    def end_block() -> None:
        words = sum(token.words for token, _ in run)
        size = sum(words > most for most in SIZES)
        block = "div" if open_blocks[-1] in PLAIN else open_blocks[-1]
        for token, linked in run:
            token.shape = f"block={block} link={linked} size={size}"
        run.clear()

    for token in page:
        if not token.name:
            run.append((token, link))
        elif not token.breaks:
            if token.name == "a":
                link = not token.closes
        elif token.name not in VOID:
            end_block()
            link = False
            if not token.closes:
                if token.name in ("p", "li") and open_blocks[-1] == token.name or open_blocks[-1] == "p":
                    close()
                open_blocks.append(token.name)
                opened[token.name] += 1
            elif opened[token.name]:
                while close() != token.name:
                    pass
    end_block()


def shapes(token: Token) -> list[str]:
    """The features of a token that do not tell whether the page marks its article."""
    if token.name:
        return [] if token.name in ARTICLE else [f"tag={token.name}"]
    return token.shape.split()


def features(token: Token) -> tuple[str, float]:
    """The feature whose weight a token has, and how many times."""
    if token.name:
        return f"tag {token.name} {token.place}", 1
    if token.place == UNMARKED:
        return f"text {token.shape} {token.place}", token.words
    return f"word {token.place}", token.words


def weight(feature: str, weights: dict[str, float]) -> float:
    """Score of a feature. Asides are cut out of the region afterwards, so they cost next to
    nothing: a long one inside an article must not end it."""
    kind, *_, place = feature.split(" ")
    if place == IN_ASIDE:
        return -LEAST / 10
    if kind == "tag":
        known = weights.get(feature)
        if known is None and place == UNMARKED:
            known = weights.get(f"tag={feature.split(' ')[1]}")
            known = None if known is None else max(known, -MOST)
        return -max(-(-TAG if known is None else known), LEAST)
    if kind == "text":
        seen = [weights[f] for f in feature.split(" ")[1:-1] if f in weights]
        return sum(max(-MOST, min(MOST, w)) for w in seen) if seen else WORD
    if place == BESIDE:
        return -abs(weights.get(feature, WORD))
    return max(weights.get(f"word {IN_ARTICLE}", WORD), WORD)


def region(page: list[Token], weights: dict[str, float]) -> tuple[int, int]:
    """The token range with the largest sum of scores; empty if no sum is positive."""
    best, start, end, total, since = 0.0, 0, 0, 0.0, 0
    for i, token in enumerate(page):
        feature, times = features(token)
        total += times * weight(feature, weights)
        if total <= 0:
            total, since = 0.0, i + 1
        elif total > best:
            best, start, end = total, since, i + 1
    return start, end


def main_text(html: str | None, weights: dict[str, float]) -> str:
    """The text of the best region without the asides in it: white space collapsed, blocks in page
    order, one space between them. Empty for null and for a page without article text."""
    page = tokens(html or "")
    start, end = region(page, weights)
    out = []
    for token in page[start:end]:
        if token.name:
            out.append(" " if token.breaks else "")
        elif token.place in (IN_ARTICLE, UNMARKED):
            out.append(token.text)
    return " ".join("".join(out).split())


def counts(html: str | None) -> Counter:
    """(feature, in article) to tokens, of a labelled page; empty for others."""
    page = tokens(html or "")
    seen: Counter = Counter()
    if any(t.place == IN_ARTICLE and t.words for t in page):
        for token in page:
            feature, times = features(token)
            if times:
                inside = token.place == IN_ARTICLE
                seen[feature, inside] += times
                seen.update({(shape, inside): times for shape in shapes(token)})
    return seen


def fit(pages: DataFrame, training_pages: int = TRAINING_PAGES) -> dict[str, float]:
    """Weights by feature: log odds of article against the rest, on about ``training_pages``
    labelled pages."""
    rows = Positions(pages).pick("html")
    share = min(1.0, training_pages / max(1, rows.count()))
    chosen = rows.filter(F.pmod(F.xxhash64("html"), F.lit(1 << 20)) < int(share * (1 << 20)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter = Counter()
            for html in batch.column(0):
                total.update(counts(html.as_py()))
            yield pa.RecordBatch.from_pylist(
                [{"feature": f, "inside": i, "n": int(n)} for (f, i), n in total.items()],
                schema=schema,
            )

    schema = pa.schema([("feature", pa.string()), ("inside", pa.bool_()), ("n", pa.int64())])
    counted = chosen.mapInArrow(run, "feature string, inside boolean, n long")
    odds: dict[str, list[float]] = {}
    for feature, inside, n in counted.groupBy("feature", "inside").agg(F.sum("n")).collect():
        odds.setdefault(feature, [0.5, 0.5])[inside] += n
    # Each kind of feature that every page has is one of several views of the same tokens.
    total: dict[str, list[float]] = {}
    for feature, seen in odds.items():
        both = total.setdefault(view(feature), [0.0, 0.0])
        both[0], both[1] = both[0] + seen[0], both[1] + seen[1]
    return {
        f: math.log(o[1] / total[view(f)][1] * total[view(f)][0] / o[0]) for f, o in odds.items()
    }


def view(feature: str) -> str:
    return feature.split("=")[0] if "=" in feature and " " not in feature else ""


def extract(pages: DataFrame, training_pages: int = TRAINING_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages(page_id, url, html)``.

    Null html is an empty page with an empty text. Repeated rows and null ids or urls come back as
    they came; broken markup ends where the page ends. Without any labelled page the weights are
    the defaults. An empty table gives no rows.
    """
    weights = fit(pages, training_pages)
    rows = Positions(pages).pick("page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py(), weights) for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    kind = rows.schema[0].dataType.simpleString()
    extracted = rows.mapInArrow(run, f"page_id {kind}, url string, text string")
    return extracted.withColumn("n_chars", F.length("text").cast("long"))
