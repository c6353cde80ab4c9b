"""Row images: which columns a record states, which are NULL, and their typed values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import types
from tidemark.functions.types import Field, typed_value
from tidemark.schema import commit_key


def stated(image: Column, name: str | Column) -> Column:
    """The key-value struct a record states for a column, the last if repeated; NULL when absent.

    Found by position from the end of the image, which stays inside generated code (a lambda would not).
    """
    at = F.array_position(F.reverse(image["key"]), F.lit(name) if isinstance(name, str) else name)
    return F.try_element_at(image, -F.nullif(at, F.lit(0)).cast("int"))


def stated_value(kv: Column, field: Field) -> Column:
    """Typed value of a stated column in a struct of one: NULL = absent, struct(NULL) = explicit NULL.

    ``kv`` is named several times: select the result of ``stated`` first and pass its column.
    """
    value = F.when(kv["tag"] != "NONE", typed_value(kv, field))
    return F.when(kv.isNotNull(), F.struct(value.alias("v")))


def typed_columns(log: DataFrame, fields: Sequence[Field], image: str = "new_data",
                  keep: Sequence[str] = ()) -> DataFrame:
    """One typed column per field of ``image``; NULL where it is absent or NULL."""
    found = log.select(*keep, *[stated(F.col(image), f.name).alias(f"_kv_{f.name}") for f in fields])
    return found.select(*keep, *[typed_value(F.col(f"_kv_{f.name}"), f).alias(f.name) for f in fields])


def table_fields(log: DataFrame, db: str, table: str) -> list[Field]:
    """The columns of a table as its records describe them; of a list that changed, all versions merged into one."""
    from tidemark.operators import versions  # which types values by this module

    found = versions.table_versions(log, db, table)
    if not found:
        raise ValueError(f"{db}.{table} has no field list")
    return versions.merged_fields(list(found.values()))


def image_states(image: Column, fields: Column) -> Column:
    """Per stated column, in schema order: struct(ordinal from 1, is_null)."""
    def state(f: Column, i: Column) -> Column:
        kv = stated(image, f["name"])
        return F.when(kv.isNotNull(), F.struct((i + 1).alias("ordinal"), (kv["tag"] == "NONE").alias("is_null")))

    return F.array_compact(F.transform(fields, state))


def row_images(log: DataFrame, keep: Sequence[str] = ("tx_seq",)) -> DataFrame:
    """One row per record and side (``before`` from keys, ``after`` from new data) with its column states."""
    sides = F.array(
        F.struct(F.lit("before").alias("side"), F.col("keys").alias("image")),
        F.struct(F.lit("after").alias("side"), F.col("new_data").alias("image")),
    )
    return (
        log.select(*keep, "fields", F.explode(sides).alias("s"))
        .filter(F.col("s.image").isNotNull())
        .select(*keep, F.col("s.side").alias("side"), image_states(F.col("s.image"), F.col("fields")).alias("states"))
    )


def present_text(states: Column) -> Column:
    return F.array_join(F.transform(states, lambda s: s["ordinal"].cast("string")), ",")


def null_text(states: Column) -> Column:
    return F.array_join(F.transform(states, lambda s: s["is_null"].cast("int").cast("string")), ",")


def present_bits(states: Column) -> Column:
    """Bits as text, one for each column from the first to the last stated, ``1`` where it is stated; of any width."""
    ordinals = F.transform(states, lambda s: s["ordinal"])
    return F.when(F.size(states) == 0, "").otherwise(F.array_join(F.transform(
        F.sequence(F.lit(1), F.array_max(ordinals)), lambda i: F.array_contains(ordinals, i).cast("int").cast("string")), ""))


def null_bits(states: Column) -> Column:
    """Bits as text, one for each *stated* column in order, ``1`` where it is NULL; of any width."""
    return F.array_join(F.transform(states, lambda s: s["is_null"].cast("int").cast("string")), "")


def _plain(kv: Column) -> Column:
    return F.struct(kv["tag"], kv["long_val"], kv["double_val"], kv["string_val"])


def changed_names() -> Column:
    """Names of columns stated on both sides with different values, in schema order."""
    def differs(f: Column) -> Column:
        before, after = (stated(F.col(side), f["name"]) for side in ("keys", "new_data"))
        return before.isNotNull() & after.isNotNull() & ~_plain(before).eqNullSafe(_plain(after))

    return F.transform(F.filter("fields", differs), lambda f: f["name"])


def stated_columns(log: DataFrame, image: str = "new_data", keep: Sequence[str] = ("tx_seq",)) -> DataFrame:
    """Values joined to their schema by name: one row per stated column, ``ordinal`` NULL for unknown names.

    The join stays inside the record, so nothing is shuffled.
    """
    names = F.col("fields")["name"]
    return log.select(*keep, names.alias("_names"), F.inline(F.transform(F.col(image), lambda e: F.struct(
        e["key"].alias("column_name"), e["tag"].alias("tag"))))).select(
        *keep, "column_name", "tag",
        F.nullif(F.array_position("_names", F.col("column_name")).cast("int"), F.lit(0)).alias("ordinal"))


def table_columns(log: DataFrame) -> DataFrame:
    """One row per column of each logged table: its latest description, metadata bytes and storage width."""
    latest = log.filter(F.col("fields").isNotNull()).groupBy("db_name", "table_").agg(
        F.max_by("fields", commit_key()).alias("fields"))
    listed = latest.select("db_name", "table_", F.posexplode("fields").alias("at", "f")).select(
        "db_name", "table_", (F.col("at") + 1).alias("ordinal"), F.col("f.name").alias("column_name"),
        F.col("f.meta.data_type").alias("declared"), F.col("f.meta.length").alias("length"),
        F.col("f.meta.precision").alias("precision"), F.col("f.meta.nullable").alias("nullable"))
    first, second = types.metadata_bytes(F.col("declared"), F.col("length"), F.col("precision"))
    return listed.withColumns({
        "type_code": types.logged_type_code(F.col("declared")),
        "meta1": first,
        "meta2": second,
        "storage_bytes": types.storage_bytes(F.col("declared"), F.col("length"), F.col("precision")),
    })


def type_lookup(columns: DataFrame) -> DataFrame:
    """Join column descriptions to the type dictionary (30 rows, so it is broadcast)."""
    dimension = types.type_dimension(columns.sparkSession)
    return columns.join(F.broadcast(dimension), "declared", "left")

