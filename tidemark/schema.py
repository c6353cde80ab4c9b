"""Envelope schema of a change log and its commit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KV = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("tag", T.StringType()),
    T.StructField("long_val", T.LongType()),
    T.StructField("double_val", T.DoubleType()),
    T.StructField("string_val", T.StringType()),
])

META = T.StructType([
    T.StructField("data_type", T.StringType()),
    T.StructField("length", T.IntegerType()),
    T.StructField("precision", T.IntegerType()),
    T.StructField("is_unsigned", T.BooleanType()),
    T.StructField("nullable", T.BooleanType()),
    T.StructField("csname", T.StringType()),
])

FIELD = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("meta", META),
])

CHANGE_SCHEMA = T.StructType([
    T.StructField("check_point", T.StringType()),
    T.StructField("db_name", T.StringType()),
    T.StructField("table_", T.StringType()),
    T.StructField("op_type", T.StringType()),
    T.StructField("ddl_sql", T.StringType()),
    T.StructField("ddl_type", T.StringType()),
    T.StructField("last_commit", T.LongType()),
    T.StructField("lsn", T.LongType()),
    T.StructField("scn", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("tx_seq", T.LongType()),
    T.StructField("msg_time", T.StringType()),
    T.StructField("tx_time", T.StringType()),
    T.StructField("dn", T.ShortType()),
    T.StructField("fields", T.ArrayType(FIELD)),
    T.StructField("keys", T.ArrayType(KV)),
    T.StructField("new_data", T.ArrayType(KV)),
    T.StructField("old_data", T.IntegerType()),
])

ORDER = ("scn", "tx_seq", "seq", "lsn", "dn")


def conform(log: DataFrame) -> DataFrame:
    """Exactly the envelope's columns and types, absent ones as NULL."""
    given = {f.name: f.dataType.simpleString() for f in log.schema.fields}

    def column(name: str, kind: str) -> str:
        if name not in given:
            return f"CAST(NULL AS {kind}) AS {name}"
        # nested columns are not rebuilt just to change whether parts may be NULL
        return name if given[name] == kind else f"CAST({name} AS {kind}) AS {name}"

    return log.selectExpr(*[column(f.name, f.dataType.simpleString()) for f in CHANGE_SCHEMA.fields])


def commit_order() -> list[Column]:
    """Columns that put records in commit order. DDL has no source node and sorts first."""
    return [F.col(c) for c in ORDER[:4]] + [F.coalesce(F.col("dn"), F.lit(-1).cast("short"))]


def commit_key() -> Column:
    """Commit order as one comparable struct, for ``max`` and ``max_by``."""
    *head, dn = commit_order()
    return F.struct(*head, dn.alias("dn"))


def is_ddl() -> Column:
    """Never NULL: a record without an operation is no definition."""
    return F.col("op_type").eqNullSafe("DDL")
