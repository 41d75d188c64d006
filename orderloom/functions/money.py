"""Money and currency expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.binding import let
from orderloom.functions.text import trim_blanks
from orderloom.schemas import CURRENCIES, MONEY

# At most 13 whole digits: a JSON number this short means the same as text.
_PLAIN = r"^[0-9]{1,13}(\.[0-9]{1,2})?\z"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
_NEGATIVE = r"^-[0-9.]*[1-9]"
_LONG_FRACTION = r"\.[0-9]{22}[0-9]*[1-9]"


def round_amount(number: Column) -> Column:
    """Number text to ``decimal(18,2)``, half-even; null outside [0, 10^15).

    The range applies before rounding. Scale 22 holds the value exactly; a longer
    fraction can never be a tie, so plain rounding of the text is right for it.
    """
    approximate = number.try_cast("double")
    wide = number.try_cast("decimal(38,22)")
    return (
        F.when(~number.rlike(_NUMBER) | number.rlike(_NEGATIVE), F.lit(None))
        .when(approximate < 0.004, F.lit(0))
        .when(approximate > 2e15, F.lit(None))
        .when(wide >= F.lit("1000000000000000").cast("decimal(38,22)"), F.lit(None))
        .when(number.rlike(_LONG_FRACTION), number.try_cast(MONEY))
        .otherwise(F.bround(wide, F.lit(2)))
        .cast(MONEY)
    )


def _number_text(text: Column) -> Column:
    """Number text without the blanks around it and without ``_``."""
    return F.replace(trim_blanks(text), F.lit("_"), F.lit(""))


def amount_text(text: Column) -> Column:
    """An amount that arrived as JSON text."""
    return F.when(text.rlike(_PLAIN), text.try_cast(MONEY)).otherwise(
        let(_number_text(text), round_amount)
    )


def _amount_of_any_kind(value: Column) -> Column:
    text = F.try_variant_get(value, "$", "string")
    kind = F.schema_of_variant(value)
    number = (
        F.when(kind == "STRING", _number_text(text))
        .when(kind == "BIGINT", text)
        .when(
            kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"),
            F.try_variant_get(value, "$", "double").cast("string"),
        )
    )
    return let(number, round_amount)


def amount(value: Column) -> Column:
    """Amount of a VARIANT that may hold text or a number; null when it is bad.

    A JSON number with a fraction or exponent counts as its nearest double.
    """
    return let(
        F.try_variant_get(value, "$", "string"),
        lambda text: F.when(text.rlike(_PLAIN), text.try_cast(MONEY)).otherwise(
            let(value, _amount_of_any_kind)
        ),
    )


def is_currency_shape(text: Column) -> Column:
    """Whether the text is exactly three letters; surrounding blanks do not pass."""
    return text.rlike(r"^\p{L}{3}\z")


def currency(text: Column) -> Column:
    """The upper-cased code when it is an accepted currency, else null."""
    return let(
        text,
        lambda t: F.when(
            is_currency_shape(t) & F.upper(t).isin(*CURRENCIES), F.upper(t)
        ),
    )
