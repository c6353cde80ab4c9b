"""Identifiers and links between records: table and source ids, definitions in force, commit chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ids import normalize_uuid
from tidemark.operators.scans import HOT_ROWS, carry_forward, numbered
from tidemark.schema import commit_key, commit_order, is_ddl

# Fixed value
MAX_TABLE_ID = (1 << 48) - 1


def _first_seen(df: DataFrame, by: list[str], place: Column, name: str) -> DataFrame:
    """Number the distinct values of ``by`` from 1 in the order they are first seen."""
    seen = df.groupBy(*by).agg(F.min(place).alias("_first"))
    return numbered(seen, [F.col("_first"), *[F.col(c) for c in by]], name).drop("_first")


def table_ids(log: DataFrame) -> DataFrame:
    """A dense id per table, in the order tables first appear in the log."""
    named = log.filter(F.col("table_").isNotNull())
    ids = _first_seen(named, ["db_name", "table_"], commit_key(), "table_id")
    return ids.withColumn("table_id", (F.col("table_id") - 1) % MAX_TABLE_ID + 1)


def source_dictionary(sources: DataFrame, place: Column) -> DataFrame:
    """``sid`` → dense ``sidno`` in first-seen order; invalid ids are left out."""
    valid = sources.withColumn("sid", normalize_uuid(F.col("sid"))).filter(F.col("sid").isNotNull())
    return _first_seen(valid, ["sid"], place, "sidno")


def source_lookup(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Add ``sidno`` for ``sid``; unknown ids get 0."""
    asked = rows.withColumn("sid", normalize_uuid(F.col("sid")))
    return asked.join(dictionary, "sid", "left").withColumn("sidno", F.coalesce("sidno", F.lit(0)))


def source_of(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Add ``sid`` for ``sidno``."""
    return rows.join(dictionary, "sidno", "left")


def schema_asof(log: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Row changes with the latest definition of their table at their place in the log (as-of, no range join)."""
    definition = F.when(is_ddl(), F.struct(F.col("tx_seq"), F.col("ddl_sql")))
    narrow = log.filter(F.col("table_").isNotNull()).select(
        "db_name", "table_", "op_type", "ddl_sql", "scn", "tx_seq", "seq", "lsn", "dn")
    carried = carry_forward(narrow, ["db_name", "table_"], commit_order(), {"_d": definition}, hot_rows=hot_rows)
    return carried.filter(~is_ddl()).select(
        "db_name", "table_", "op_type", "scn", "tx_seq", "seq", "lsn", "dn",
        F.col("_d.tx_seq").alias("ddl_tx_seq"), F.col("_d.ddl_sql").alias("ddl_sql"))


def commit_gaps(log: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per source, each row change with the previous transaction and the gap its ``last_commit`` leaves to it."""
    narrow = log.filter(~is_ddl()).select("scn", "tx_seq", "seq", "lsn", "dn", "last_commit")
    chained = carry_forward(narrow, ["dn"], commit_order(), {"prev_tx_seq": F.col("tx_seq")}, strict=True, hot_rows=hot_rows)
    return chained.withColumn("gap", F.col("last_commit") - F.col("prev_tx_seq"))


def commit_groups(log: DataFrame) -> DataFrame:
    """Transactions that may commit in parallel: equal ``last_commit``."""
    return log.groupBy("last_commit").agg(
        F.count(F.lit(1)).alias("n"), F.min("tx_seq").alias("first_tx"), F.max("tx_seq").alias("last_tx"))
