"""Number columns: widths, signs, decimals, bits, ordinals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
MAX_SPARK_DIGITS = 38
DECIMAL_BYTES = [0, 1, 1, 2, 2, 3, 3, 4, 4]   # bytes for 0 to 8 decimal digits; 9 digits take 4


def whole_div(value: Column, by: int | Column) -> Column:
    """Exact integer division (towards zero)."""
    return F.call_function("div", value, F.lit(by))


def narrow_int(value: Column, bits: int) -> Column:
    """Keep the low ``bits`` of a bigint, sign-extended (wraps instead of raising)."""
    if bits >= 64:
        return value
    return F.shiftright(F.shiftleft(value, 64 - bits), 64 - bits)


def unsigned_int(value: Column, bits: int) -> Column:
    """Read the low ``bits`` of a two's complement bigint as an unsigned number."""
    if bits < 64:
        return value.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
    wide = value.cast("decimal(20,0)")
    return F.when(value < 0, (wide + F.lit(str(1 << 64)).cast("decimal(20,0)")).cast("decimal(20,0)")).otherwise(wide)


def fixed_width_text(value: Column, length: int, decimals: int) -> Column:
    """A double with ``decimals`` digits; NULL if its whole part needs more than ``length - decimals - 1``
    characters. ``length`` 0 puts no limit."""
    text = F.translate(F.format_number(value, decimals), ",", "")  # rounds the binary value, not its shortest text
    if length == 0:
        return text
    whole = F.length(F.substring_index(text, ".", 1))
    return F.when(whole <= length - decimals - 1, F.substring(text, 1, length))


def fixed_width_number(value: Column, length: int, decimals: int, single: bool = False) -> Column:
    """``fixed_width_text`` read back as a double, or as a float when ``single``."""
    return fixed_width_text(value, length, decimals).cast("float" if single else "double")


def decimal_value(text: Column, precision: int, scale: int, mode: str = "half_up") -> Column:
    """Decimal text → exact decimal; text is kept beyond 38 digits. ``mode='trunc'`` cuts extra digits."""
    if precision > MAX_SPARK_DIGITS:
        return text
    if mode == "trunc":
        text = F.regexp_replace(text, rf"^(-?\d*\.\d{{0,{scale}}})\d*$", "$1")
    return text.try_cast(f"decimal({precision},{scale})")


def _digit_bytes(digits: Column) -> Column:
    table = F.array(*[F.lit(b) for b in DECIMAL_BYTES])
    return (whole_div(digits, 9) * 4 + F.element_at(table, (digits % 9).cast("int") + 1)).cast("int")


def decimal_bytes(precision: Column, scale: Column) -> Column:
    """Bytes of a packed decimal."""
    return _digit_bytes(precision - scale) + _digit_bytes(scale)


def digit_count(value: Column) -> Column:
    """Decimal digits of a whole number (0 has one)."""
    return F.length(F.abs(value).cast("string"))


def bit_text(value: Column, length: int) -> Column:
    """The low ``length`` bits of a BIT value, most significant first."""
    return F.lpad(F.right(F.bin(value), F.lit(length)), length, "0")


def enum_label(labels: Column, ordinal: Column) -> Column:
    """ENUM ordinal (from 1) → label; 0 is the empty label, others NULL."""
    return F.when(ordinal == 0, "").otherwise(F.try_element_at(labels, F.when(ordinal > 0, ordinal).cast("int")))


def set_labels(labels: Column, mask: Column) -> Column:
    """SET bit mask → array of labels in declaration order."""
    return F.filter(labels, lambda _l, i: F.call_function("shiftright", mask, i).bitwiseAND(F.lit(1).cast("long")) == 1)


def declared_labels(ddl_sql: Column, kind: str) -> Column:
    """Labels of the first ``enum(...)`` or ``set(...)`` in a table definition."""
    listed = F.regexp_extract(ddl_sql, rf"(?i)\b{kind}\s*\(([^)]*)\)", 1)
    return F.regexp_extract_all(listed, F.lit(r"'([^']*)'"), F.lit(1))
