"""The order contract: ordered rules, exact first error, canonical projection.

Input is a frame of raw JSON lines. Every rule is a Column expression, so the whole
check is narrow: no shuffle, no Python in the tasks. A document is parsed once and cast
once to leaves that keep their JSON type. One condition then clears the good rows; only
rows that fail it look for the first broken rule and its exact message.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import hashing, json_values, money, text, timestamps
from orderloom.functions.binding import let
from orderloom.schemas import LINE, STATUSES
from orderloom.session import prepare

_ORDER_COLUMNS = (
    "order_id",
    "order_number",
    "created_at",
    "updated_at",
    "status",
    "channel",
    "currency",
    "total_amount",
    "lines",
)

# A cast to these types turns a value of the wrong kind into null, level by level;
# VARIANT leaves keep the JSON type of values whose type matters.
_RAW_MONEY = "struct<gross struct<amount variant, currency string>>"
_RAW_LINE = (
    "struct<node variant, id variant, productName variant, productSku variant, "
    f"variantSku variant, quantity variant, unitPrice {_RAW_MONEY}, totalPrice {_RAW_MONEY}>"
)
_RAW_HEAD = (
    "struct<id variant, number variant, created variant, updatedAt variant, status variant, "
    f"channel struct<slug variant, currencyCode variant>, total {_RAW_MONEY}>"
)


def _step(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """Keep some columns and add others that are computed once per row.

    Plain projections would be merged, and filters on their results copied below them,
    which repeats the work per reference; a one-element generator keeps them apart.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*keep, row.alias("_row")).select(*keep, F.inline(F.array("_row")))


def _message(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _all(*conditions: Column) -> Column:
    """All conditions hold; an unknown one counts as false."""
    return F.coalesce(reduce(Column.__and__, conditions), F.lit(False))


def _trimmed(value: Column) -> Column:
    return text.trim_blanks(json_values.as_text(value))


def _read(raw: Column) -> Column:
    """Typed leaves of one line of text; a line that is not whole JSON has no head."""

    def leaves(document):
        plain = F.try_variant_get(document, "$[0].lines", f"array<{_RAW_LINE}>")
        connection = json_values.connection_lines(document, ".lines", _RAW_LINE)
        return F.when(
            json_values.is_whole(document, raw),
            F.struct(
                F.try_variant_get(document, "$[0]", _RAW_HEAD).alias("head"),
                F.coalesce(plain, connection).alias("lines"),
            ),
        )

    return let(json_values.parse_line(raw), leaves)


def _price(owner: Column, name: str) -> tuple[Column, Column]:
    """Currency of a price, and which of its objects is missing if one is."""
    missing = F.when(owner.isNull(), "owner").when(owner["gross"].isNull(), "gross")
    return owner["gross"]["currency"].alias(f"{name}_currency"), missing.alias(f"{name}_missing")


def _line_values(line: Column) -> Column:
    """Canonical values of one raw line; a null marks a value that broke its type."""
    sku = json_values.preferred_sku(line["productSku"], line["variantSku"])
    return F.struct(
        F.struct(
            _trimmed(line["id"]).alias("line_id"),
            _trimmed(line["productName"]).alias("product_name"),
            _trimmed(sku).alias("sku"),
            json_values.positive_quantity(line["quantity"]).alias("quantity"),
            money.amount(line["unitPrice"]["gross"]["amount"]).alias("unit_amount"),
            money.amount(line["totalPrice"]["gross"]["amount"]).alias("line_amount"),
        ).alias("line"),
        F.coalesce(F.schema_of_variant(sku) != "VOID", F.lit(False)).alias("has_sku"),
        line.isNull().alias("is_missing"),
        *_price(line["unitPrice"], "unit"),
        *_price(line["totalPrice"], "total"),
    )


def _line_is_good(values: Column, currency: Column) -> Column:
    """Whether a line breaks no rule of its own; repeated IDs are a matter of the order."""
    line = values["line"]
    return _all(
        line["line_id"] != "",
        line["quantity"].isNotNull(),
        line["product_name"] != "",
        ~values["has_sku"] | (F.coalesce(line["sku"], F.lit("")) != ""),
        values["unit_currency"] == currency,
        line["unit_amount"].isNotNull(),
        values["total_currency"] == currency,
        line["line_amount"].isNotNull(),
    )


def _money_error(
    given: Column, missing: Column, value: Column, currency: Column, owner: str, prefix
) -> Column:
    """First broken rule of a price."""
    return F.when(
        ~given.eqNullSafe(currency),
        F.when(missing == "owner", F.lit(f"{owner} must be an object"))
        .when(missing == "gross", _message(prefix, " must be a money object"))
        .otherwise(_message(prefix, " currency must match order currency")),
    ).when(value.isNull(), _message(prefix, ".amount must be numeric"))


def _line_error(values: Column, index: Column, first_repeat: Column, currency: Column) -> Column:
    """First broken rule of one line; ``first_repeat`` is where a line ID first recurs."""
    at = _message("lines[", index.cast("string"), "]")
    line = values["line"]
    return F.coalesce(
        F.when(values["is_missing"], _message(at, " must be an object")),
        F.when(text.is_blank(line["line_id"]), _message(at, ".id must be a nonempty string")),
        F.when(index == first_repeat, F.lit("line IDs must be unique strings")),
        F.when(
            line["quantity"].isNull(), _message(at, ".quantity must be a positive integer")
        ),
        F.when(
            text.is_blank(line["product_name"]),
            _message(at, ".productName must be a nonempty string"),
        ),
        F.when(
            values["has_sku"] & text.is_blank(line["sku"]), F.lit("sku must be a nonempty string")
        ),
        _money_error(
            values["unit_currency"],
            values["unit_missing"],
            line["unit_amount"],
            currency,
            "unitPrice",
            _message(at, ".unitPrice.gross"),
        ),
        _money_error(
            values["total_currency"],
            values["total_missing"],
            line["line_amount"],
            currency,
            "totalPrice",
            _message(at, ".totalPrice.gross"),
        ),
    )


def repeated_positions(ids: Column) -> Column:
    """Positions (from 0) whose ID already stands earlier in the array, by sorting it."""

    def repeats(ranked):
        again = F.transform(
            ranked,
            lambda x, i: F.when(
                (i > 0) & (F.get(ranked, i - 1)["id"] == x["id"]), x["position"]
            ),
        )
        return F.sort_array(F.filter(again, lambda position: position.isNotNull()))

    ranked = F.sort_array(
        F.transform(ids, lambda x, i: F.struct(x.alias("id"), i.alias("position")))
    )
    return let(ranked, repeats)


def _values(read: DataFrame, keep: list[str]) -> DataFrame:
    """Canonical values; null where a value is missing or has the wrong type."""
    head = F.col("_read")["head"]
    total_currency, total_missing = _price(head["total"], "_total")
    return _step(
        read,
        keep,
        order_id=_trimmed(head["id"]),
        order_number=_trimmed(head["number"]),
        created_at=timestamps.utc_timestamp(json_values.as_text(head["created"])),
        updated_at=timestamps.utc_timestamp(json_values.as_text(head["updatedAt"])),
        status=_trimmed(head["status"]),
        channel=_trimmed(head["channel"]["slug"]),
        currency=money.currency(json_values.as_text(head["channel"]["currencyCode"])),
        total_amount=money.amount(head["total"]["gross"]["amount"]),
        _total_currency=total_currency,
        _total_missing=total_missing,
        _lines=F.transform(F.col("_read")["lines"], _line_values),
    )


def _is_good() -> Column:
    """Whether the row breaks no rule."""
    ids = F.col("_lines")["line"]["line_id"]
    return _all(
        F.col("currency").isNotNull(),
        F.size("_lines") > 0,
        F.forall("_lines", lambda x: _line_is_good(x, F.col("currency"))),
        # Hash-based, so that long orders stay linear.
        F.size(F.array_distinct(ids)) == F.size(ids),
        F.col("updated_at") >= F.col("created_at"),
        F.col("status").isin(*STATUSES),
        F.col("order_id") != "",
        F.col("order_number") != "",
        F.col("channel") != "",
        F.col("_total_currency") == F.col("currency"),
        F.col("total_amount").isNotNull(),
    )


def _lines_error(lines: Column) -> Column:
    """First broken rule among the lines; ``lines`` is the value that has them."""
    ids = F.col("_lines")["line"]["line_id"]

    def first_of_lines(first_repeat):
        errors = F.transform(
            "_lines", lambda x, i: _line_error(x, i, first_repeat, F.col("currency"))
        )
        return F.get(F.filter(errors, lambda e: e.isNotNull()), F.lit(0))

    def of_connection(items):
        return F.when(items.isNull(), F.lit("line connection must contain a list")).when(
            _has_lines() & F.exists(items, lambda item: ~json_values.is_object(item)),
            F.lit("line must be an object"),
        )

    return F.coalesce(
        F.when(
            json_values.is_object(lines), let(json_values.connection_items(lines), of_connection)
        ),
        F.when(~_has_lines(), F.lit("lines must contain at least one line")),
        # Most orders repeat no ID, which takes no sorting to see.
        let(
            F.when(F.size(F.array_distinct(ids)) != F.size(ids), F.array_min(repeated_positions(ids))),
            first_of_lines,
        ),
    )


def _has_lines() -> Column:
    return F.coalesce(F.size("_lines") >= 1, F.lit(False))


def _channel_error(channel: Column) -> Column:
    """Why there is no accepted currency."""

    def of_code(code):
        letters = F.coalesce(money.is_currency_shape(json_values.as_text(code)), F.lit(False))
        return (
            F.when(~json_values.is_present(code), F.lit("channel.currencyCode is required"))
            .when(~letters, F.lit("channel.currencyCode must be a three-letter currency"))
            .otherwise(F.lit("currency must be USD, EUR or PLN"))
        )

    return F.when(
        ~json_values.is_object(channel) & ~json_values.is_empty(channel),
        F.lit("channel must be an object"),
    ).otherwise(let(json_values.inside(channel, "$.currencyCode"), of_code))


def _timestamp_error(document: Column, name: str) -> Column:
    no_zone = timestamps.lacks_zone(json_values.as_text(json_values.field(document, f".{name}")))
    return F.when(no_zone, F.lit(f"{name} must include a timezone")).otherwise(
        F.lit(f"{name} must be an ISO-8601 timestamp")
    )


def _first_error(document: Column, raw: Column) -> Column:
    """The first broken rule of a bad row, in contract order."""

    def required(column, name):
        return F.when(text.is_blank(F.col(column)), F.lit(f"{name} must be a nonempty string"))

    return F.coalesce(
        F.when(~json_values.is_whole(document, raw), F.lit("record must be valid JSON")),
        F.when(~json_values.is_object(document, "$[0]"), F.lit("record must be a JSON object")),
        F.when(
            F.col("currency").isNull(), let(json_values.field(document, ".channel"), _channel_error)
        ),
        let(json_values.field(document, ".lines"), _lines_error),
        F.when(F.col("created_at").isNull(), _timestamp_error(document, "created")),
        F.when(F.col("updated_at").isNull(), _timestamp_error(document, "updatedAt")),
        F.when(
            F.col("updated_at") < F.col("created_at"), F.lit("updatedAt must not precede created")
        ),
        required("status", "status"),
        F.when(~F.col("status").isin(*STATUSES), F.lit("unsupported order status")),
        required("order_id", "id"),
        required("order_number", "number"),
        required("channel", "channel.slug"),
        _money_error(
            F.col("_total_currency"),
            F.col("_total_missing"),
            F.col("total_amount"),
            F.col("currency"),
            "total",
            F.lit("total.gross"),
        ),
    )


def payload_json(lines: Column) -> Column:
    """Canonical JSON text of an order: fields by name, times as UTC text."""
    fields = {name: F.col(name) for name in _ORDER_COLUMNS if name != "lines"}
    fields["created_at"] = timestamps.canonical_text(F.col("created_at"))
    fields["updated_at"] = timestamps.canonical_text(F.col("updated_at"))
    fields["lines"] = lines
    return hashing.canonical_json(*[fields[name].alias(name) for name in sorted(fields)])


def judge(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """Check raw JSON lines against the contract.

    Adds ``error`` (first broken rule, null for a valid order) and the canonical order
    columns, all null on an invalid row. The raw text and other columns stay.
    """
    prepare(lines.sparkSession)
    keep, text_line = lines.columns, F.col(raw)
    heads = [name for name in _ORDER_COLUMNS if name != "lines"]
    values = _values(_step(lines, keep, _read=_read(text_line)), keep)
    bad = let(json_values.parse_line(text_line), lambda document: _first_error(document, text_line))
    judged = _step(
        values,
        [*keep, *heads],
        error=F.when(~_is_good(), bad),
        lines=F.sort_array(F.col("_lines")["line"]).cast(f"array<{LINE}>"),
    )
    valid = F.col("error").isNull()
    final = _step(
        judged,
        [*keep, *heads, "lines", "error"],
        payload_json=F.when(valid, payload_json(F.col("lines"))),
    )
    return final.select(
        *keep,
        "error",
        *[F.when(valid, F.col(name)).alias(name) for name in _ORDER_COLUMNS],
        "payload_json",
        hashing.payload_hash(F.col("payload_json")).alias("payload_hash"),
    )
