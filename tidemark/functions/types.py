"""Declared column types: codes, classes, metadata bytes, storage widths and value handlers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import numeric, text, time

# Declared type name, type name in the log, type code in the log
TYPE_CODES = [
    ("TINYINT", "TINY", 1),
    ("SMALLINT", "SHORT", 2),
    ("SHORT", "SHORT", 2),
    ("MEDIUMINT", "INT24", 9),
    ("INT", "LONG", 3),
    ("BIGINT", "LONGLONG", 8),
    ("FLOAT", "FLOAT", 4),
    ("DOUBLE", "DOUBLE", 5),
    ("DECIMAL", "NEWDECIMAL", 246),
    ("NULL", "NULL", 6),
    ("CHAR", "STRING", 254),
    ("VARCHAR", "VARCHAR", 15),
    ("BINARY", "STRING", 254),
    ("TINYTEXT", "TINY_BLOB", 249),
    ("TEXT", "BLOB", 252),
    ("MEDIUMTEXT", "MEDIUM_BLOB", 250),
    ("LONGTEXT", "LONG_BLOB", 251),
    ("TINYBLOB", "TINY_BLOB", 249),
    ("BLOB", "BLOB", 252),
    ("MEDIUMBLOB", "MEDIUM_BLOB", 250),
    ("LONGBLOB", "LONG_BLOB", 251),
    ("TIMESTAMP", "TIMESTAMP", 7),
    ("DATE", "DATE", 10),
    ("TIME", "TIME", 11),
    ("DATETIME", "DATETIME", 12),
    ("YEAR", "YEAR", 13),
    ("BIT", "BIT", 16),
    ("ENUM", "ENUM", 247),
    ("SET", "SET", 248),
    ("JSON", "JSON", 245),
]
FIXED_WIDTHS = {
    "NULL": 0, "TINYINT": 1, "SMALLINT": 2, "SHORT": 2, "MEDIUMINT": 3, "INT": 4, "BIGINT": 8,
    "FLOAT": 4, "DOUBLE": 8, "YEAR": 1, "DATE": 1, "TIME": 3, "TIMESTAMP": 4, "DATETIME": 5,
}
BLOB_LENGTH_BYTES = {
    "TINYTEXT": 1, "TEXT": 2, "MEDIUMTEXT": 3, "LONGTEXT": 4,
    "TINYBLOB": 1, "BLOB": 2, "MEDIUMBLOB": 3, "LONGBLOB": 4, "JSON": 4,
}
INTEGER_BITS = {"TINYINT": 8, "SMALLINT": 16, "SHORT": 16, "MEDIUMINT": 24, "INT": 32, "BIGINT": 64}
MAX_DECIMAL_DIGITS = 65

_CODES = {declared: code for declared, _, code in TYPE_CODES}
_INTEGERS = list(INTEGER_BITS)
_NUMBERS = _INTEGERS + ["FLOAT", "DOUBLE", "DECIMAL"]
_STRINGS = ["CHAR", "BINARY", "VARCHAR", *BLOB_LENGTH_BYTES, "ENUM", "SET"]
TYPE_CLASSES: dict[str, list[str]] = {
    "integer": _INTEGERS,
    "numeric": _NUMBERS,
    "string": _STRINGS,
    "temporal": ["TIME", "DATETIME", "TIMESTAMP", "DATE", "YEAR"],
    "with_time": ["TIME", "DATETIME", "TIMESTAMP"],
    "with_date": ["DATE", "DATETIME", "TIMESTAMP"],
    "with_date_and_time": ["DATETIME", "TIMESTAMP"],
    "has_sign": _NUMBERS + ["YEAR"],
}


def type_dimension(spark: SparkSession) -> DataFrame:
    """The type dictionary as a table of fixed size."""
    return spark.createDataFrame(TYPE_CODES, "declared string, code_name string, code int")


def type_code(declared: Column) -> Column:
    """Type code of a declared type; NULL if it is unknown."""
    pairs = [part for name, code in _CODES.items() for part in (F.lit(name), F.lit(code))]
    return F.try_element_at(F.create_map(*pairs), declared)


def is_known(declared: Column) -> Column:
    """Whether a declared type has a code (false for NULL)."""
    return F.coalesce(declared.isin(list(_CODES)), F.lit(False))


def logged_type_code(declared: Column) -> Column:
    """Type code as a table map states it: all blobs and texts count as BLOB."""
    blob = declared.isin([t for t in BLOB_LENGTH_BYTES if t != "JSON"])
    return F.when(blob, 252).otherwise(type_code(declared))


def in_class(declared: Column, name: str) -> Column:
    return declared.isin(TYPE_CLASSES[name])


def _lookup(declared: Column, table: dict[str, int]) -> Column:
    pairs = [part for name, value in table.items() for part in (F.lit(name), F.lit(value))]
    return F.try_element_at(F.create_map(*pairs), declared)


def enum_bytes(labels: Column) -> Column:
    return F.when(labels < 256, 1).otherwise(2)


def set_bytes(labels: Column) -> Column:
    size = numeric.whole_div(labels + 7, 8).cast("int")
    return F.when(size > 4, 8).otherwise(size)


# Types whose width depends on the column, as negative entries of the width table
_BY_LENGTH = {"CHAR": -1, "BINARY": -1, "VARCHAR": -2, "DECIMAL": -3, "ENUM": -4, "SET": -5, "BIT": -6}


def width_for(width: Column, length: Column, precision: Column) -> Column:
    """Storage bytes from an entry of the width table: the entry itself, or what the column's length makes of it."""
    return (
        F.when(width >= 0, width)
        .when(width == _BY_LENGTH["CHAR"], F.when(length < 256, 1).otherwise(2))
        .when(width == _BY_LENGTH["VARCHAR"], F.when(length < 255, 1).otherwise(2))
        .when(width == _BY_LENGTH["DECIMAL"], numeric.decimal_bytes(F.least(length, F.lit(MAX_DECIMAL_DIGITS)), precision))
        .when(width == _BY_LENGTH["ENUM"], enum_bytes(length))
        .when(width == _BY_LENGTH["SET"], set_bytes(length))
        .when(width == _BY_LENGTH["BIT"], numeric.whole_div(length + 7, 8).cast("int"))
    )


def storage_bytes(declared: Column, length: Column, precision: Column) -> Column:
    """Bytes a value takes; for strings the length prefix only."""
    return width_for(_lookup(declared, {**FIXED_WIDTHS, **BLOB_LENGTH_BYTES, **_BY_LENGTH}), length, precision)


def type_traits(declared: Column) -> Column:
    """struct(width, prefixed, metadata): storage bytes (negative where they depend on the length), whether bytes
    follow the width, and the number of metadata bytes; by one lookup."""
    widths = {**FIXED_WIDTHS, **BLOB_LENGTH_BYTES, **_BY_LENGTH}
    prefixed = {"CHAR", "BINARY", "VARCHAR", *BLOB_LENGTH_BYTES}
    two = {"DECIMAL", "CHAR", "BINARY", "VARCHAR", "ENUM", "SET", "BIT"}
    one = {"FLOAT", "DOUBLE", *BLOB_LENGTH_BYTES}
    entries = ", ".join(
        f"'{t}', named_struct('width', {w}, 'prefixed', {t in prefixed}, 'metadata', {2 if t in two else 1 if t in one else 0})"
        for t, w in widths.items())
    return F.try_element_at(F.expr(f"map({entries})"), declared)


def is_prefixed(declared: Column) -> Column:
    """Types whose value is a length prefix and bytes."""
    return declared.isin("CHAR", "BINARY", "VARCHAR", *BLOB_LENGTH_BYTES)


def blob_type_for(length: Column) -> Column:
    """Smallest blob type that holds ``length`` bytes."""
    return (F.when(length < 1 << 8, "TINYBLOB").when(length < 1 << 16, "BLOB")
            .when(length < 1 << 24, "MEDIUMBLOB").otherwise("LONGBLOB"))


def metadata_bytes(declared: Column, length: Column, precision: Column) -> tuple[Column, Column]:
    """The (up to two) metadata bytes a table map states for a column; NULL where there is none."""
    byte = F.lit(255)
    first = (
        F.when(declared == "DECIMAL", F.least(length, F.lit(MAX_DECIMAL_DIGITS)))
        .when(declared.isin("FLOAT", "DOUBLE"), _lookup(declared, FIXED_WIDTHS))
        .when(declared.isin("CHAR", "BINARY"),
              F.lit(_CODES["CHAR"]).bitwiseXOR(F.shiftright(length.bitwiseAND(F.lit(0x300)), 4)))
        .when(declared == "VARCHAR", length.bitwiseAND(byte))
        .when(declared.isin("ENUM", "SET"), type_code(declared))
        .when(declared == "BIT", length % 8)
        .otherwise(_lookup(declared, BLOB_LENGTH_BYTES))
    )
    second = (
        F.when(declared == "DECIMAL", precision)
        .when(declared.isin("CHAR", "BINARY"), (length * 4).bitwiseAND(byte))
        .when(declared == "VARCHAR", F.shiftright(length, 8))
        .when(declared == "ENUM", enum_bytes(length))
        .when(declared == "SET", set_bytes(length))
        .when(declared == "BIT", numeric.whole_div(length, 8).cast("int"))
    )
    return first.cast("int"), second.cast("int")


def metadata_size(declared: Column) -> Column:
    """How many metadata bytes a column has."""
    return (F.when(declared.isin("DECIMAL", "CHAR", "BINARY", "VARCHAR", "ENUM", "SET", "BIT"), 2)
            .when(declared.isin("FLOAT", "DOUBLE", *BLOB_LENGTH_BYTES), 1).otherwise(0))


@dataclass(frozen=True)
class Field:
    """A column of a logged table, as its records describe it."""

    name: str
    data_type: str
    length: int = 0
    precision: int = 0
    is_unsigned: bool = False
    nullable: bool = True


Handler = Callable[[Column, Field], Column]
"""Builds the typed value from a key-value struct."""

_HANDLERS: dict[str, Handler] = {}


def register_type(*declared: str) -> Callable[[Handler], Handler]:
    """Register (or replace) the value handler of declared types."""

    def keep(handler: Handler) -> Handler:
        _HANDLERS.update(dict.fromkeys(declared, handler))
        return handler

    return keep


def handler_for(declared: str) -> Handler | None:
    return _HANDLERS.get(declared)


def typed_value(kv: Column, field: Field) -> Column:
    """The typed value of a key-value struct; NULL for the NONE tag."""
    handler = handler_for(field.data_type)
    if handler is None:
        raise KeyError(f"no handler for type {field.data_type}")
    return handler(kv, field)


@register_type(*INTEGER_BITS)
def _integer(kv: Column, field: Field) -> Column:
    bits = INTEGER_BITS[field.data_type]
    value = kv["long_val"]
    if field.is_unsigned:
        target = {8: "short", 16: "int", 24: "int", 32: "long", 64: "decimal(20,0)"}[bits]
        return numeric.unsigned_int(value, bits).cast(target)
    target = {8: "byte", 16: "short", 24: "int", 32: "int", 64: "long"}[bits]
    return numeric.narrow_int(value, bits).cast(target)


@register_type("FLOAT", "DOUBLE")
def _floating(kv: Column, field: Field) -> Column:
    single = field.data_type == "FLOAT"
    if field.length == 0 and field.precision == 0:
        return kv["double_val"].cast("float" if single else "double")
    return numeric.fixed_width_number(kv["double_val"], field.length, field.precision, single)


@register_type("DECIMAL")
def _decimal(kv: Column, field: Field) -> Column:
    return numeric.decimal_value(kv["string_val"], field.length, field.precision)


@register_type("CHAR", "VARCHAR", "TINYTEXT", "TEXT", "MEDIUMTEXT", "LONGTEXT")
def _characters(kv: Column, field: Field) -> Column:
    return text.decode_text(kv["string_val"])


@register_type("BINARY", "TINYBLOB", "BLOB", "MEDIUMBLOB", "LONGBLOB")
def _bytes(kv: Column, field: Field) -> Column:
    return text.decode_bytes(kv["string_val"])


@register_type("JSON")
def _json(kv: Column, field: Field) -> Column:
    return text.json_text(kv["string_val"])


@register_type("DATE")
def _date(kv: Column, field: Field) -> Column:
    return time.parse_datetime(text.decode_text(kv["string_val"])).cast("date")


@register_type("DATETIME")
def _datetime(kv: Column, field: Field) -> Column:
    return time.parse_datetime(text.decode_text(kv["string_val"]))


@register_type("TIMESTAMP")
def _timestamp(kv: Column, field: Field) -> Column:
    decoded = text.decode_text(kv["string_val"])
    offset = F.coalesce(time.trailing_zone(decoded), F.lit(time.SOURCE_OFFSET_HOURS * 3600))
    return F.timestamp_micros(time.ntz_micros(time.parse_datetime(decoded)) - offset * 1_000_000)


@register_type("TIME")
def _time(kv: Column, field: Field) -> Column:
    return time.parse_time(text.decode_text(kv["string_val"]))


@register_type("YEAR")
def _year(kv: Column, field: Field) -> Column:
    return kv["long_val"].try_cast("int")


@register_type("BIT", "SET")
def _bits(kv: Column, field: Field) -> Column:
    return kv["long_val"]


@register_type("ENUM")
def _ordinal(kv: Column, field: Field) -> Column:
    return kv["long_val"].try_cast("int")


@register_type("NULL")
def _null(kv: Column, field: Field) -> Column:
    return F.lit(None).cast("string")
