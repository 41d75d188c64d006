"""Strictly typed access to raw JSON through VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.binding import let


#: Stands for numbers that the parser does not take: a number, not empty, in no range, no integer.
_OUT_OF_RANGE = "1e300"
#: Number literals outside strings that valid records may hold in fields nobody reads. A whole
#: number of more than 4,300 digits is none of them.
_NOT_FINITE = r"(?<![\w.+-])(?:NaN|-?Infinity)(?![\w.])"
_LONG_WHOLE = r"(?<![\w.+-])-?[1-9][0-9]{300,4299}(?![\w.])"
_LONG_MANTISSA = r"(?<![\w.+-])-?[1-9][0-9]{300,}+(?:\.[0-9]++(?:[eE]\+?[0-9]++)?|[eE]\+?[0-9]++)(?![\w.-])"
_LONG_FRACTION = r"(\.[0-9]{100})[0-9]++"
_LONG_EXPONENT = r"([0-9][eE][+-]?)0*+([0-9]{4})[0-9]++"
_LONG_POWER = r"[eE][+-]?[0-9]{5}"
#: Stand for an escaped backslash and an escaped quote; raw control characters are not JSON.
_BACKSLASH, _QUOTE = "\x01", "\x02"


def _names_no_number(raw: Column) -> Column:
    return raw.contains("NaN") | raw.contains("Infinity")


def _if_any(test, value: Column, *replacements: tuple[str, str]) -> Column:
    """The text with some patterns replaced; a cheap test spares most texts the search for them."""

    def replaced(text):
        found = text
        for pattern, by in replacements:
            found = F.regexp_replace(found, pattern, by)
        return F.when(test(text), found).otherwise(text)

    return let(value, replaced)


def with_plain_literals(raw: Column) -> Column:
    """The line with the numbers that the parser refuses replaced, outside of strings.

    ``NaN``, ``Infinity`` and numbers of very many digits become numbers it takes: out of range
    where they were, else cut to more digits than matter. Strings keep every character: with
    escapes out of the way, the quotes part the line into what is outside (the first piece and
    every second one) and inside of strings. What is outside is searched at once, with a quote where
    a string stood, which no pattern matches. Null for a line with the characters that stand for
    escapes meanwhile.
    """
    plain = F.replace(raw, F.lit("\\\\"), F.lit(_BACKSLASH))
    plain = F.replace(plain, F.lit('\\"'), F.lit(_QUOTE))

    def outside(pieces):
        found = F.array_join(F.filter(pieces, lambda _, i: i % 2 == 0), '"')
        found = _if_any(_names_no_number, found, (_NOT_FINITE, _OUT_OF_RANGE))
        found = _if_any(
            lambda x: x.rlike("[0-9]{101}"),
            found,
            (_LONG_WHOLE, _OUT_OF_RANGE),
            (_LONG_MANTISSA, _OUT_OF_RANGE),
            (_LONG_FRACTION, "$1"),
        )
        found = _if_any(lambda x: x.rlike(_LONG_POWER), found, (_LONG_EXPONENT, "$1$2"))
        return F.split(found, '"')

    def replaced(pieces):
        return let(
            outside(pieces),
            lambda found: F.transform(
                pieces,
                lambda piece, i: F.when(i % 2 == 0, F.get(found, (i / 2).cast("int"))).otherwise(piece),
            ),
        )

    pieces = let(F.split(plain, '"'), replaced)
    joined = F.replace(F.array_join(pieces, '"'), F.lit(_QUOTE), F.lit('\\"'))
    joined = F.replace(joined, F.lit(_BACKSLASH), F.lit("\\\\"))
    return F.when(~raw.rlike(f"[{_BACKSLASH}{_QUOTE}]"), joined)


def parse_line(raw: Column) -> Column:
    """Parse one line as ``[record, check]``.

    The JSON parser stops after the first value, so text after it would pass
    unseen. With the line's own hash as second element, ``is_whole`` is true only
    when the line held exactly one value. A refused line with odd number literals is tried a
    second time without them.
    """
    check = F.concat(F.lit(","), F.xxhash64(raw).cast("string"), F.lit("]"))

    def parsed(text):
        return F.try_parse_json(F.concat(F.lit("["), text, check))

    odd = _names_no_number(raw) | raw.rlike("[0-9]{301}") | raw.rlike(_LONG_POWER)
    again = F.when(odd, let(with_plain_literals(raw), parsed))
    return F.coalesce(parsed(raw), again)


def is_whole(document: Column, raw: Column) -> Column:
    """Whether the parsed line was one JSON value and nothing else."""
    return F.coalesce(
        F.try_variant_get(document, "$[1]", "bigint") == F.xxhash64(raw), F.lit(False)
    )


def field(document: Column, path: str) -> Column:
    """A VARIANT inside the record: null when missing, VOID for a JSON null."""
    return F.try_variant_get(document, f"$[0]{path}", "variant")


def inside(value: Column, path: str) -> Column:
    """A VARIANT inside another VARIANT."""
    return F.try_variant_get(value, path, "variant")


def is_object(value: Column, path: str = "$") -> Column:
    """Whether the VARIANT, or the one at a path inside, is a JSON object; false when it is missing.

    Only an object can be cast to a struct; what its fields hold is not read.
    """
    return F.try_variant_get(value, path, "struct<_ boolean>").isNotNull()


def as_text(value: Column) -> Column:
    """The text of a JSON string; null for every other type."""
    return F.when(
        F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string")
    )


def as_integer(value: Column) -> Column:
    """The value of a JSON integer; null for ``true``, ``2.0``, ``"2"`` and the like."""
    return F.when(
        F.schema_of_variant(value) == "BIGINT", F.try_variant_get(value, "$", "bigint")
    )


def positive_quantity(value: Column) -> Column:
    """A true JSON integer from 1 to 2147483647, else null."""
    return let(
        as_integer(value), lambda n: F.when(n.between(1, 2147483647), n.cast("int"))
    )


def is_present(value: Column) -> Column:
    """Whether the value is neither missing, a JSON null nor the empty string."""
    return F.coalesce(~F.to_json(value).isin("null", '""'), F.lit(False))


def is_empty(value: Column) -> Column:
    """Whether the value is missing, null, false, zero or an empty text/list/object."""
    text = F.to_json(value)
    return (
        value.isNull()
        | text.isin("null", "false", '""', "[]", "{}")
        | F.coalesce(
            ~F.schema_of_variant(value).isin("STRING", "BOOLEAN")
            & (F.try_variant_get(value, "$", "double") == 0),
            F.lit(False),
        )
    )


def as_list(value: Column) -> Column:
    """Elements of a JSON array; null for every other type."""
    return F.try_variant_get(value, "$", "array<variant>")


def unwrap_node(item: Column) -> Column:
    """The item's ``node`` when that key exists (even when null), else the item."""
    return F.coalesce(inside(item, "$.node"), item)


def connection_items(lines: Column) -> Column:
    """Items of an ``edges``/``nodes`` object; null when the chosen value is no list."""
    edges, nodes = inside(lines, "$.edges"), inside(lines, "$.nodes")
    return (
        F.when(~is_empty(edges), as_list(edges))
        .when(~is_empty(nodes), as_list(nodes))
        .otherwise(F.array().cast("array<variant>"))
    )


def connection_lines(document: Column, path: str, line_type: str) -> Column:
    """Unwrapped items of a connection as ``line_type``; null when it is no connection.

    Items that are no objects become null elements. ``line_type`` has a VARIANT field
    ``node``. The usual shapes, every edge with a node object and nodes without one of
    their own, take one cast; all others are unwrapped item by item.
    """

    def cast_at(name, kind):
        return F.try_variant_get(document, f"$[0]{path}.{name}", kind)

    def item_by_item(lines):
        return F.when(
            is_object(lines),
            F.transform(
                connection_items(lines),
                lambda item: F.try_variant_get(unwrap_node(item), "$", line_type),
            ),
        )

    def usual_edges(edges):
        usual = (F.size(edges) > 0) & F.forall(edges, lambda x: x["node"].isNotNull())
        return F.when(usual, edges["node"])

    def usual_nodes(nodes):
        usual = (F.size(nodes) > 0) & F.forall(
            nodes, lambda x: x.isNotNull() & x["node"].isNull()
        )
        return F.when(usual, nodes)

    return F.coalesce(
        let(cast_at("edges", f"array<struct<node {line_type}>>"), usual_edges),
        F.when(
            is_empty(field(document, f"{path}.edges")),
            let(cast_at("nodes", f"array<{line_type}>"), usual_nodes),
        ),
        let(field(document, path), item_by_item),
    )


def preferred_sku(product_sku: Column, variant_sku: Column) -> Column:
    """``productSku`` when that key exists, even with a null, else ``variantSku``."""
    return F.coalesce(product_sku, variant_sku)
