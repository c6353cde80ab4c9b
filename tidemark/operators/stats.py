"""Counts and volumes over a log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import commit_micros
from tidemark.operators.scans import HOT_ROWS, carry_forward, hot_keys
from tidemark.schema import is_ddl


def events_per_record() -> Column:
    return F.when(is_ddl(), 2).otherwise(5)


def progress_counts(log: DataFrame) -> DataFrame:
    """Records read and events written per table and operation."""
    return log.groupBy("db_name", "table_", "op_type").agg(
        F.count(F.lit(1)).alias("n_records"), F.sum(events_per_record()).alias("n_events"))


def volume_rollup(log: DataFrame) -> DataFrame:
    """``progress_counts`` with subtotals per table, per database and overall."""
    return log.rollup("db_name", "table_", "op_type").agg(
        F.grouping_id().cast("int").alias("level"),
        F.count(F.lit(1)).alias("n_records"), F.sum(events_per_record()).alias("n_events"))


def column_change_stats(log: DataFrame) -> DataFrame:
    """How often each column is stated, and stated as NULL, per table, operation and side of the change."""
    def side(name: str, image: str) -> Column:
        return F.transform(F.coalesce(F.col(image), F.array().cast(kinds[image])), lambda e: F.struct(
            F.lit(name).alias("side"), e["key"].alias("column_name"), (e["tag"] == "NONE").alias("is_null")))

    kinds = dict(log.dtypes)
    stated = log.select("db_name", "table_", "op_type", F.explode(
        F.concat(side("before", "keys"), side("after", "new_data"))).alias("e"))
    return stated.groupBy("db_name", "table_", "op_type", "e.side", F.col("e.column_name").alias("column_name")).agg(
        F.count(F.lit(1)).alias("n_present"), F.count_if(F.col("e.is_null")).alias("n_null"))


def with_message_time(log: DataFrame) -> DataFrame:
    return log.withColumn("msg_ts", F.timestamp_micros(commit_micros(F.col("msg_time"))))


def throughput(log: DataFrame, window: str = "1 minute", slide: str | None = None) -> DataFrame:
    """Records per window of message time (tumbling, or sliding with ``slide``)."""
    timed = log if "msg_ts" in log.columns else with_message_time(log)
    return timed.groupBy(F.window("msg_ts", window, slide).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("window_start"), "n")


def key_sessions(rows: DataFrame, key: Sequence[str], at: str, tie: Sequence[str], gap_seconds: int,
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """Sessions of each key: runs of rows at most ``gap_seconds`` apart.

    The start of its session is carried to every row, and sessions are then counted by an aggregate, so neither
    a busy key nor a long session is held by one task.
    """
    order = [F.col(at), *[F.col(c) for c in tie]]
    narrow = rows.select(*key, at, *tie)
    hot = hot_keys(narrow, key, hot_rows)
    chained = carry_forward(narrow, key, order, {"_prev": F.unix_micros(at)}, strict=True, hot=hot)
    opens = F.col("_prev").isNull() | (F.unix_micros(at) - F.col("_prev") > gap_seconds * 1_000_000)
    opened = carry_forward(chained, key, order, {"session_start": F.when(opens, F.col(at))}, hot=hot)
    return opened.groupBy(*key, "session_start").agg(F.count(F.lit(1)).alias("n"), F.max(at).alias("session_end"))


def hot_rows_report(rows: DataFrame, key: Sequence[str], k: int) -> DataFrame:
    """The ``k`` keys with most changes."""
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.col("n").desc(), *[F.col(c).asc() for c in key]).limit(k)
