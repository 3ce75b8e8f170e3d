"""Eight-byte big-endian row versions: conversions to and from numbers and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 16  # eight bytes


def from_number(value: Column) -> Column:
    """bigint to binary(8)."""
    return F.unhex(F.lpad(F.hex(value.cast("bigint")), HEX_DIGITS, "0"))


def to_bigint(version: Column) -> Column:
    """binary(8) to bigint; the top bit is the sign, as in the database's own conversion."""
    return F.conv(F.hex(version), 16, -10).cast("bigint")


def to_int(version: Column) -> Column:
    """The low four bytes as a signed int; higher bytes are cut off."""
    low = F.conv(F.right(F.hex(version), F.lit(8)), 16, 10).cast("bigint")
    return F.when(low >= 2**31, low - 2**32).otherwise(low).cast("int")


def to_hex_text(version: Column) -> Column:
    return F.concat(F.lit("0x"), F.hex(version))


def to_text(version: Column, charset: str = "UTF-8") -> Column:
    """The bytes read as characters."""
    return F.decode(version, charset)


def literal(hex_text: str) -> Column:
    """A binary constant from '0x...' text, padded on the left to eight bytes."""
    digits = hex_text[2:] if hex_text[:2].lower() == "0x" else hex_text
    return F.unhex(F.lit(digits.rjust(HEX_DIGITS, "0").upper()))
