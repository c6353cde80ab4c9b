"""Change logs as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.operators.stats import events_per_record, with_message_time
from tidemark.schema import CHANGE_SCHEMA

# Fixed values
INTAKE_INTERVAL = "100 milliseconds"
LATENESS = "10 minutes"


def stream_change_log(spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None,
                      max_bytes: str | None = None) -> DataFrame:
    """Stream change records from a folder. ``max_files`` or ``max_bytes`` bound what one micro-batch takes in:
    a slow job holds the intake back instead of buffering."""
    reader = spark.readStream.format(fmt).schema(CHANGE_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def start(writer: DataStreamWriter, checkpoint: str, drain: bool = False,
          interval: str = INTAKE_INTERVAL) -> StreamingQuery:
    """Start a query that resumes from ``checkpoint``. ``drain`` takes what is there and stops."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=interval)
    return writer.start()


def with_progress(log: DataFrame, name: str = "progress") -> DataFrame:
    """Report records, events and the last transaction of each micro-batch in the query's progress."""
    return log.observe(
        name, F.count(F.lit(1)).alias("n_records"), F.sum(events_per_record()).alias("n_events"),
        F.max("tx_seq").alias("last_tx"))


def deduplicated(log: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """One record per commit position, for copies that arrive within ``lateness`` of each other."""
    return with_message_time(log).withWatermark("msg_ts", lateness).dropDuplicatesWithinWatermark(
        ["scn", "tx_seq", "seq", "lsn", "dn"])


def windowed(log: DataFrame, window: str, slide: str | None = None, lateness: str = LATENESS) -> DataFrame:
    """Records per window of message time; a window is final once the watermark passes it."""
    timed = with_message_time(log).withWatermark("msg_ts", lateness)
    return timed.groupBy(F.window("msg_ts", window, slide).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("window_start"), "n")


def sessions(rows: DataFrame, key: list[str], at: str, gap: str, lateness: str = LATENESS) -> DataFrame:
    """Rows per session of each key."""
    grouped = rows.withWatermark(at, lateness).groupBy(*key, F.session_window(at, gap).alias("w"))
    return grouped.agg(F.count(F.lit(1)).alias("n")).select(*key, F.col("w.start").alias("session_start"), "n")
