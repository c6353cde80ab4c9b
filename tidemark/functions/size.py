"""Bytes each event of a record takes in the log."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import numeric, types
from tidemark.functions.text import decoded_length

# Fixed values
HEADER_BYTES = 19
GTID_BYTES = 73               # with one commit time; 7 more with two
SECOND_TIME_BYTES = 7
BEGIN_BYTES = 38              # plus the database name
DDL_QUERY_BYTES = 33          # plus status variables, database name and statement
STATUS_BYTES_WITH_DB = 45     # plus the database name
STATUS_BYTES_WITHOUT_DB = 43
TABLE_MAP_BYTES = 8
ROWS_BYTES = 10
XID_BYTES = 27
ROTATE_BYTES = 27             # plus the segment name
SEGMENT_HEADER_BYTES = 122    # what a new segment holds before its first event
SEGMENT_RESERVE_BYTES = 200   # kept free for the pointer to the next segment
SEGMENT_LIMIT_BYTES = 20_971_520
SERVER_ID = 100


def length_of_length(n: Column) -> Column:
    """Bytes of a length-encoded integer."""
    return F.when(n < 251, 1).when(n < 1 << 16, 3).when(n < 1 << 24, 4).otherwise(9)


def _ceil8(n: Column) -> Column:
    return numeric.whole_div(n + 7, 8).cast("int")


def _bytes_of(c: Column) -> Column:
    return F.coalesce(F.octet_length(c), F.lit(0))


UNROLLED = 16
"""Columns and values of a record up to which they are taken one by one in plain expressions, which become generated code;
a lambda over them is interpreted for every value. Longer ones go through the lambda."""


def _each(items: Column, use: Callable[[Column, Column], Column]) -> Column:
    """``use`` of each entry and its place (from 0)."""
    plain = F.array(*[use(F.get(items, F.lit(i)), F.lit(i)) for i in range(UNROLLED)])
    return F.when(F.size(items) <= UNROLLED, F.slice(plain, F.lit(1), F.size(items))).otherwise(F.transform(items, use))


def _total(values: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, values)


def field_traits(fields: Column) -> Column:
    """``type_traits`` of each column, in schema order."""
    return _each(fields["meta"]["data_type"], lambda t, _: types.type_traits(t))


def field_widths(fields: Column, traits: Column) -> Column:
    """Storage bytes per column, in schema order; for strings the bytes of the length prefix."""
    return _each(fields["meta"], lambda m, i: F.coalesce(
        types.width_for(F.get(traits, i)["width"], m["length"], m["precision"]), F.lit(0)))


def _latest_only(image: Column) -> Column:
    """Drop all but the last of repeated column names."""
    names = image["key"]
    last = F.filter(image, lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), e["key"]))
    return F.when(F.size(F.array_distinct(names)) == F.size(names), image).otherwise(last)


IMAGE_PARTS = ("key", "tag", "string_val")
"""What sizes read of the values of an image. Taken apart, no more of an image is built than that."""


def image_bytes(image: Sequence[Column], names: Column, widths: Column, prefixed: Column) -> Column:
    """Presence map, NULL map and values of a row image, given as its ``IMAGE_PARTS``; 0 when there is no image.

    ``names``, ``widths`` and ``prefixed`` describe the table's columns, in schema order. NULL values take no bytes.
    """
    def value_bytes(key: Column, tag: Column, text: Column) -> Column:
        at = F.array_position(names, key).cast("int")
        payload = F.when((tag == "STRING") & F.element_at(prefixed, at), decoded_length(text))
        return F.when(tag != "NONE", F.element_at(widths, at) + F.coalesce(payload, F.lit(0))).otherwise(0)

    keys, maps = image[0], _ceil8(F.size(names))
    # places beyond the end of an image have no tag and count 0
    each = [value_bytes(*[F.get(part, F.lit(i)) for part in image]) for i in range(UNROLLED)]
    plain = maps + _ceil8(F.size(keys)) + _total(each)
    stated_once = F.size(F.array_distinct(keys)) == F.size(keys)
    kept = _latest_only(F.arrays_zip(*[part.alias(name) for part, name in zip(image, IMAGE_PARTS)]))
    values = F.aggregate(kept, F.lit(0), lambda total, e: total + value_bytes(*[e[name] for name in IMAGE_PARTS]))
    return (F.when(keys.isNull(), 0).when((F.size(keys) <= UNROLLED) & stated_once, plain)
            .otherwise(maps + _ceil8(F.size(kept)) + values))


def gtid_bytes(immediate: Column, original: Column) -> Column:
    return F.lit(GTID_BYTES) + F.when(immediate == original, 0).otherwise(SECOND_TIME_BYTES)


def begin_bytes(db: Column) -> Column:
    return F.lit(BEGIN_BYTES) + _bytes_of(db)


def ddl_query_bytes(db: Column, sql: Column) -> Column:
    status = F.when(db.isNull(), STATUS_BYTES_WITHOUT_DB).otherwise(STATUS_BYTES_WITH_DB + _bytes_of(db))
    return F.lit(DDL_QUERY_BYTES) + status + _bytes_of(db) + _bytes_of(sql)


def table_map_bytes(db: Column, table: Column, traits: Column) -> Column:
    columns = F.size(traits)
    each = traits["metadata"]
    plain = _total([F.coalesce(F.get(each, F.lit(i)), F.lit(0)) for i in range(UNROLLED)])
    metadata = F.when(columns <= UNROLLED, plain).otherwise(
        F.aggregate(each, F.lit(0), lambda total, m: total + F.coalesce(m, F.lit(0))))
    names = F.lit(0)
    for name in (db, table):
        names = names + length_of_length(_bytes_of(name)) + _bytes_of(name) + 1
    return (F.lit(HEADER_BYTES + TABLE_MAP_BYTES) + names + length_of_length(columns) + columns + metadata
            + F.when(metadata < 251, 1).otherwise(3) + _ceil8(columns))


def rows_bytes(keys: Sequence[Column], new_data: Sequence[Column], names: Column, widths: Column, prefixed: Column) -> Column:
    return (F.lit(HEADER_BYTES + ROWS_BYTES) + length_of_length(F.size(names))
            + image_bytes(keys, names, widths, prefixed) + image_bytes(new_data, names, widths, prefixed))


def rotate_bytes(name: Column) -> Column:
    return F.lit(ROTATE_BYTES) + _bytes_of(name)
