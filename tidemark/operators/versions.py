"""Versions of a table's field list: columns that come, go and change their type along a log.

Every record is typed by the list it carries; a record without one by the list in force at its place. The version table
has one row for each (table, field list) with the interval of the commit order in which it is stated. ``merged_fields``
puts all versions of a table into one list, widening the types of columns that were retyped.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.types import INTEGER_BITS, Field, typed_value
from tidemark.operators.images import stated
from tidemark.operators.scans import HOT_ROWS, carry_forward
from tidemark.schema import commit_key, commit_order

_TEXTS = ("CHAR", "VARCHAR", "TINYTEXT", "TEXT", "MEDIUMTEXT", "LONGTEXT")
_TIMES = ("DATE", "DATETIME")


def version_id() -> Column:
    """Hash of a record's field list; NULL where it carries none."""
    return F.when(F.col("fields").isNotNull(), F.xxhash64("fields"))


def field_versions(log: DataFrame) -> DataFrame:
    """db_name, table_, version, first and last (commit keys), n_records and fields of each list that records state.

    One row for each task and list is shuffled: the lists themselves are gathered as a set of one.
    """
    return log.filter(F.col("fields").isNotNull() & F.col("table_").isNotNull()).groupBy("db_name", "table_", version_id().alias("version")).agg(
        F.min(commit_key()).alias("first"), F.max(commit_key()).alias("last"), F.count(F.lit(1)).alias("n_records"),
        F.get(F.collect_set("fields"), F.lit(0)).alias("fields"))


def with_version(log: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Row changes with ``version``: that of their own list, or the last one stated for their table before them."""
    rows = log.filter(~F.col("op_type").eqNullSafe("DDL"))
    return carry_forward(rows, ["db_name", "table_"], commit_order(), {"version": version_id()}, hot_rows=hot_rows)


def _fields(listed) -> list[Field]:
    return [Field(f["name"], f["meta"]["data_type"], f["meta"]["length"] or 0, f["meta"]["precision"] or 0,
                  bool(f["meta"]["is_unsigned"]), bool(f["meta"]["nullable"])) for f in listed]


def table_versions(log: DataFrame, db: str, table: str) -> dict[int, list[Field]]:
    """The field lists of one table by version, in the order they were last stated."""
    own = field_versions(log.filter((F.col("db_name") == db) & (F.col("table_") == table)))
    return {r["version"]: _fields(r["fields"]) for r in own.orderBy("last").collect()}


def widened(a: Field, b: Field) -> Field:
    """One column for both descriptions: the type of the later one if it is the same, else one that holds both."""
    nullable = a.nullable or b.nullable
    if a.data_type == b.data_type and a.is_unsigned == b.is_unsigned:
        return Field(b.name, b.data_type, max(a.length, b.length), max(a.precision, b.precision), b.is_unsigned, nullable)
    integers = a.data_type in INTEGER_BITS and b.data_type in INTEGER_BITS
    if integers:
        bits = max(INTEGER_BITS[f.data_type] + (a.is_unsigned != b.is_unsigned and f.is_unsigned) for f in (a, b))
        if bits <= 64:
            kind = next(t for t, n in INTEGER_BITS.items() if n >= bits)
            return Field(b.name, kind, 0, 0, a.is_unsigned and b.is_unsigned, nullable)
        return Field(b.name, "DECIMAL", 20, 0, False, nullable)
    numbers = {*INTEGER_BITS, "FLOAT", "DOUBLE", "DECIMAL"}
    if a.data_type in numbers and b.data_type in numbers:
        return Field(b.name, "DOUBLE", 0, 0, False, nullable)
    if a.data_type in _TIMES and b.data_type in _TIMES:
        return Field(b.name, "DATETIME", 0, 0, False, nullable)
    return Field(b.name, "LONGTEXT", 0, 0, False, nullable)


def merged_fields(versions: Sequence[Sequence[Field]]) -> list[Field]:
    """All columns of all versions: those of the latest in its order, then the dropped ones, latest first."""
    found: dict[str, Field] = {}
    for fields in versions:
        for f in fields:
            found[f.name] = widened(found[f.name], f) if f.name in found else f
    names = [f.name for fields in reversed(versions) for f in fields]
    return [found[name] for name in dict.fromkeys(names)]


def _spark_type(field: Field) -> str:
    """What a value of a column is as a Spark type; text where types do not meet."""
    if field.data_type in INTEGER_BITS:
        bits = INTEGER_BITS[field.data_type]
        return {8: "short", 16: "int", 24: "int", 32: "long", 64: "decimal(20,0)"}[bits] if field.is_unsigned else {
            8: "byte", 16: "short", 24: "int", 32: "int", 64: "long"}[bits]
    kinds = {"FLOAT": "float", "DOUBLE": "double", "DECIMAL": f"decimal({min(max(field.length, 1), 38)},{min(field.precision, 38)})",
             "DATE": "date", "DATETIME": "timestamp_ntz"}
    return kinds.get(field.data_type, "string" if field.data_type in _TEXTS else "")


def typed_versions(log: DataFrame, db: str, table: str, image: str = "new_data", keep: Sequence[str] = (),
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """One typed row for each row change of a table: ``keep``, ``version`` and the merged columns of all its versions.

    A value is typed by the description of its own version and then cast to the merged type. Columns a version does not
    have, and columns a record does not state, are NULL.
    """
    versions = table_versions(log, db, table)
    merged = merged_fields(list(versions.values()))
    own = with_version(log.filter((F.col("db_name") == db) & (F.col("table_") == table)), hot_rows)
    found = own.select(*keep, "version", *[stated(F.col(image), f.name).alias(f"_kv_{f.name}") for f in merged])

    def value(field: Field) -> Column:
        kinds: dict[Field, list[int]] = {}
        for version, fields in versions.items():
            for f in fields:
                if f.name == field.name:
                    kinds.setdefault(f, []).append(version)
        target = _spark_type(field)
        typed = [(F.col("version").isin(ids), typed_value(F.col(f"_kv_{field.name}"), f)) for f, ids in kinds.items()]
        if len(typed) == 1 and field == next(iter(kinds)):
            return F.when(*typed[0]).alias(field.name)
        cast = [(condition, v.try_cast(target) if target else v.cast("string")) for condition, v in typed]
        return reduce(lambda out, case: out.when(*case), cast[1:], F.when(*cast[0])).alias(field.name)

    return found.select(*keep, "version", *[value(f) for f in merged])
