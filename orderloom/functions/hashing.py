"""Canonical JSON, payload hashes and order-independent fingerprints."""

from __future__ import annotations

import zlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.binding import let


def canonical_json(*fields: Column) -> Column:
    """JSON text with a fixed field order and nulls kept."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def payload_hash(text: Column) -> Column:
    """SHA-256 of the text, as lowercase hex."""
    return F.sha2(text, 256)


def row_text(*columns: Column) -> Column:
    """One text per row that keeps nulls and separators apart."""
    return F.to_json(F.array(*[c.cast("string") for c in columns]))


#: A SHA-256 digest is combined in so many words of 32 bits.
_WORDS = 8


def _crc_images() -> list[tuple[int, int]]:
    """``(bit, word)``: which word of four bytes gives each bit of a CRC-32, constant apart.

    The CRC-32 of four bytes is a one-to-one linear map of their bits, XOR a constant. Gauss-Jordan
    elimination over its values for the single bits inverts the map.
    """
    constant = zlib.crc32(bytes(4))
    rows = [(zlib.crc32((1 << i).to_bytes(4, "big")) ^ constant, 1 << i) for i in range(32)]
    for bit in range(32):
        image, word = next(row for row in rows[bit:] if row[0] >> bit & 1)
        rest = [row for row in rows if row != (image, word)]
        rest = [(x ^ image, w ^ word) if x >> bit & 1 else (x, w) for x, w in rest]
        rows = [*rest[:bit], (image, word), *rest[bit:]]
    return [(bit, word) for bit, (_, word) in enumerate(rows)]


def _four_bytes(crc: Column) -> Column:
    """Eight hex digits of the four bytes that have a CRC-32, the constant apart."""
    bits = [
        F.shiftright(crc, bit).bitwiseAND(F.lit(1)) * F.lit(word).cast("bigint")
        for bit, word in _crc_images()
    ]
    return F.lpad(F.hex(reduce(Column.bitwiseXOR, bits)), 8, "0")


def _pieces(crcs: Column, odd: Column) -> Column:
    """Four numbers of 60 bits of the combined digest, by the CRC-32 of its words."""
    constant = F.when(odd, F.lit(zlib.crc32(bytes(4)))).otherwise(F.lit(0)).cast("bigint")
    words = F.transform(crcs, lambda crc: _four_bytes(crc.bitwiseXOR(constant)))
    starts = F.array(*map(F.lit, (1, 16, 31, 46)))
    return let(
        F.array_join(words, ""),
        lambda digits: F.transform(starts, lambda start: F.conv(F.substring(digits, start, F.lit(15)), 16, 10)),
    )


def fingerprint(row: Column) -> Column:
    """Aggregate over row texts: ``count:a:b:c:d``, whatever the row order.

    Four 60-bit pieces of each row's SHA-256 are combined by XOR, so the aggregate
    is a fixed-size buffer that combines map-side. Equal rows cancel in pairs; put a
    unique column into the row text.
    """
    return fingerprint_of_digests(F.unhex(F.sha2(row, 256)))


def fingerprint_of_digests(digest: Column) -> Column:
    """``fingerprint`` by the SHA-256 of the row texts, as 32 bytes.

    Nothing in Spark reads bytes as a number as cheaply as CRC-32 does, and of four bytes it is a
    one-to-one linear map. So the CRC-32 of the words of the digests are combined, and turned back
    into digits once for the whole aggregate.
    """
    n = F.count(digest)
    crcs = [
        F.coalesce(F.bit_xor(F.crc32(F.substring(digest, 1 + 4 * i, 4))), F.lit(0))
        for i in range(_WORDS)
    ]
    return F.concat_ws(":", n.cast("string"), _pieces(F.array(*crcs), n % 2 == 1))


def _stored_text(field: T.StructField) -> Column:
    """A text that differs whenever the stored value does.

    A cast gives times all their digits and doubles the shortest text that names their bits.
    """
    if isinstance(field.dataType, T.ArrayType | T.StructType | T.MapType):
        return F.to_json(F.struct(field.name), {"ignoreNullFields": "false"})
    return F.col(field.name).cast("string")


def whole_row(df: DataFrame, *without: str) -> Column:
    """The text of every column but ``without``, in the order of the schema, for a fingerprint.

    Each value has its length before it, so that long texts are not escaped; ``-`` is a null.
    """
    texts = [_stored_text(f) for f in df.schema if f.name not in without]
    return F.concat(
        *[
            F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
            for text in texts
        ]
    )


def row_digest(df: DataFrame, *without: str) -> Column:
    """SHA-256 of ``whole_row``; as a column of its own it is taken once a row."""
    return F.unhex(F.sha2(whole_row(df, *without), 256))


def table_fingerprint(df: DataFrame, *without: str) -> str:
    """Fingerprint of a whole table, of every column but ``without``."""
    row = df.select(row_digest(df, *without).alias("row"))
    return row.agg(fingerprint_of_digests(F.col("row")).alias("f")).first()["f"]
