"""Text checks: Unicode trim, required text and identifiers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as blank at the ends of a text field.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
IDENTIFIER = "[A-Za-z0-9][A-Za-z0-9_-]{0,79}"


def trim_blanks(text: Column) -> Column:
    """Drop Unicode blanks from both ends (``trim`` alone drops only spaces)."""
    return F.btrim(text, F.lit(BLANKS))


def trim_blanks_right(text: Column) -> Column:
    """Drop Unicode blanks from the end only."""
    return F.rtrim(text, F.lit(BLANKS))


def is_blank(text: Column) -> Column:
    """Whether trimmed text is missing or empty."""
    return F.coalesce(text, F.lit("")) == ""


def is_identifier(text: Column) -> Column:
    """Whether the whole text is a valid snapshot or release ID."""
    return text.rlike(rf"^{IDENTIFIER}\z")


def identifier(value: str) -> str:
    """The given snapshot or release ID; the rule is that of ``is_identifier``."""
    if re.compile(IDENTIFIER).fullmatch(value) is None:
        raise ValueError(f"not a usable ID: {value!r} (want {IDENTIFIER})")
    return value
