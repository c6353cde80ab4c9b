"""Record-level decoding: operation, definition class, times, and the records that cannot be used."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ids, time, types
from tidemark.schema import is_ddl

# Event codes of row changes
ROW_EVENT_CODES = {"I": 30, "U": 31, "D": 32}

# Reasons a record is refused
UNKNOWN_OP = "UNKNOWN_OP"
UNKNOWN_TYPE = "UNKNOWN_TYPE"
UNKNOWN_COLUMN = "SCHEMA_FIELD_NOT_EXIST"
TOO_MANY_VALUES = "TOO_MANY_VALUES"
BAD_TIME = "BAD_TIME"
BAD_CHECKPOINT = "INVALID_CHECKPOINT"


def row_event_code(op: Column) -> Column:
    code = F.lit(None).cast("int")
    for name, value in ROW_EVENT_CODES.items():
        code = F.when(op == name, value).otherwise(code)
    return code


def count_parts(log: DataFrame) -> DataFrame:
    """(part, n): how many records there are in all, of definitions and row changes, and of usable and refused ones.

    One pass over the log. Conditions are worked out as columns: as filters they would be written into the recipe of the
    log, with each column spelled out anew wherever a condition names it.
    """
    marked = log.select(is_ddl().alias("ddl"), is_refused().alias("refused"))
    parts = {"all": F.lit(True), "ddl": F.col("ddl"), "dml": ~F.col("ddl"), "usable": ~F.col("refused"), "refused": F.col("refused")}
    counted = marked.agg(*[F.count_if(c).alias(part) for part, c in parts.items()])
    return counted.select(F.inline(F.array(*[F.struct(F.lit(part).alias("part"), F.col(part).alias("n")) for part in parts])))


def ddl_class() -> Column:
    kind = F.col("ddl_type")
    return (
        F.when(kind.isNull(), "drop db / procedure / function")
        .when((kind == "CREATE TABLE") & F.col("db_name").isNull(), "create db")
        .when(kind == "CREATE TABLE", "create table")
        .when(kind == "DROP TABLE", "drop table")
        .otherwise("other")
    )


def commit_times(log: DataFrame) -> DataFrame:
    """Add ``immediate_us`` and ``original_us`` (epoch microseconds)."""
    return log.withColumns({
        "immediate_us": time.commit_micros(F.col("msg_time")),
        "original_us": time.commit_micros(F.col("tx_time")),
    })


def _column_names(image: str) -> Column:
    return F.coalesce(F.col(image)["key"], F.array().cast("array<string>"))


def faults() -> dict[str, Column]:
    """What makes a record unusable: reason → condition (never NULL)."""
    dml = ~is_ddl()
    known = F.coalesce(F.col("fields")["name"], F.array().cast("array<string>"))
    strange_type = F.exists(F.col("fields")["meta"]["data_type"], lambda t: ~types.is_known(t))
    strange_name = (F.size(F.array_except(_column_names("keys"), known))
                    + F.size(F.array_except(_column_names("new_data"), known))) > 0
    crowded = F.greatest(F.size(_column_names("keys")), F.size(_column_names("new_data"))) > F.size(known)
    bad_time = time.commit_micros(F.col("msg_time")).isNull() | time.commit_micros(F.col("tx_time")).isNull()
    return {
        UNKNOWN_OP: dml & row_event_code(F.col("op_type")).isNull(),
        UNKNOWN_TYPE: dml & F.coalesce(strange_type, F.lit(True)),
        UNKNOWN_COLUMN: dml & strange_name,
        TOO_MANY_VALUES: dml & crowded,
        BAD_TIME: bad_time,
        BAD_CHECKPOINT: ~ids.is_checkpoint(F.col("check_point")),
    }


def is_refused() -> Column:
    """Whether a record cannot be used (never NULL)."""
    return reduce(lambda a, b: a | b, faults().values())


def split_refused(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable records, refused records with ``reasons``).

    Records are sorted out by plain conditions; reasons are spelled out for refused records only.
    """
    refused = is_refused()
    reasons = F.array_compact(F.array(*[F.when(c, reason) for reason, c in faults().items()]))
    return log.filter(~refused), log.filter(refused).withColumn("reasons", reasons)
