"""Catalogue entries of streams. Each writes a derived log to the shared folder, streams it to its end in several
micro-batches, and returns what its batch twin would."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import events
from tidemark.operators.images import stated
from tidemark.operators.stats import with_message_time
from tidemark.plans import logs_sql as sql
from tidemark.plans.derive import EVENT_FIELDS, ORDER_FIELDS, events_log, orders_log, table
from tidemark.plans.registry import ORACLE, query
from tidemark.session import shared_dir
from tidemark.sources.change_log import write_change_log
from tidemark.streaming import sinks, source


BATCHES = 4
"""Micro-batches in which a landed log is taken in."""


def width(spark: SparkSession) -> int:
    """Files a log or a batch of it is written as: one for each task that can run at once, four at least."""
    return max(4, spark.sparkContext.defaultParallelism)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder of the shared folder."""
    unique = spark.sql("SELECT uuid()").first()[0]
    return f"{shared_dir(spark)}/{name}-{spark.sparkContext.applicationId}-{unique}"


def landed(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """The orders log written as files, each a range of commit order: for each of ``BATCHES`` micro-batches one per task
    (a file may be one row group, which one task reads)."""
    path = f"{folder}/log"
    write_change_log(orders_log(spark, sf_dir, ranges=BATCHES * width(spark)), path)
    return path


def landed_in_order(spark: SparkSession, log: DataFrame, folder: str) -> str:
    """``log`` written a quarter after the other, so that files arrive in commit order (a watermark needs that)."""
    path = f"{folder}/log"
    cuts = log.agg(F.percentile_approx("scn", [0.25, 0.5, 0.75])).first()[0]
    quarter = sum((F.col("scn") > cut).cast("int") for cut in cuts)
    for i in range(len(cuts) + 1):
        write_change_log(log.filter(quarter == i).repartition(width(spark)), path)
    return path


def drained(writer, folder: str) -> None:
    source.start(writer, f"{folder}/checkpoint", drain=True).awaitTermination()


@query("stream_ingest", f"""
WITH {sql.O_LOG} SELECT op_type, count(*) AS n_records, CAST(count(*) * 5 AS BIGINT) AS n_events, max(tx_seq) AS last_tx
FROM o_log GROUP BY op_type""")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "ingest")
    stream = source.stream_change_log(spark, landed(spark, sf_dir, folder), max_files=width(spark))
    drained(sinks.batch_writer(source.with_progress(stream), f"{folder}/out"), folder)
    return sinks.read_batches(spark, f"{folder}/out").groupBy("op_type").agg(
        F.count(F.lit(1)).alias("n_records"), (F.count(F.lit(1)) * 5).alias("n_events"), F.max("tx_seq").alias("last_tx"))


@query("stream_sink", ORACLE["dml_events"])
def stream_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "sink")
    stream = source.stream_change_log(spark, landed(spark, sf_dir, folder), max_files=2 * BATCHES)
    drained(sinks.ordered_writer(stream, f"{folder}/out", lambda batch: events.own_parts(events.dml_events(batch))), folder)
    return sinks.read_batches(spark, f"{folder}/out").select("tx_seq", "event_ord", "event_type", "event_code")


@query("stream_replay", ORACLE["replay_apply"])
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "replay")
    key = ["o_orderkey"]
    stream = source.stream_change_log(spark, landed(spark, sf_dir, folder), max_files=width(spark))
    drained(sinks.replay_writer(stream, f"{folder}/states", ORDER_FIELDS, key), folder)
    return sinks.read_table(spark, f"{folder}/states", table(spark, sf_dir, "orders").limit(0), key)


@query("stream_replay_events", ORACLE["replay_events"])
def stream_replay_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in any order: the log is dealt out over the files, so batches are not ranges of commit order."""
    folder = scratch(spark, "replay-events")
    write_change_log(events_log(spark, sf_dir).repartition(width(spark), "lsn"), f"{folder}/log")
    stream = source.stream_change_log(spark, f"{folder}/log", max_files=width(spark) // 4)
    drained(sinks.replay_writer(stream, f"{folder}/states", EVENT_FIELDS, ["user_id"]), folder)
    empty = spark.createDataFrame([], "user_id bigint, value double, props string")
    return sinks.read_table(spark, f"{folder}/states", empty, ["user_id"])


@query("stream_dedup", f"WITH {sql.E_LOG} SELECT tx_seq, op_type, CAST(1 AS BIGINT) AS n FROM e_log")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events log with every fifth record twice, copies in the same file."""
    folder = scratch(spark, "dedup")
    log = events_log(spark, sf_dir)
    doubled = log.unionAll(log.filter(F.col("tx_seq") % 5 == 0))
    stream = source.stream_change_log(spark, landed_in_order(spark, doubled, folder), max_files=width(spark))
    unique = source.deduplicated(stream).select("tx_seq", "op_type")
    drained(unique.writeStream.format("parquet").option("path", f"{folder}/out"), folder)
    return spark.read.parquet(f"{folder}/out").groupBy("tx_seq", "op_type").agg(F.count(F.lit(1)).alias("n"))


@query("stream_throughput", """
WITH t AS (SELECT epoch_us(ts) // 3600000000 AS h FROM events)
SELECT make_timestamp(h * 3600000000) AS window_start, count(*) AS n FROM t GROUP BY h
HAVING (h + 1) * 3600000000 <= (SELECT max(epoch_us(ts)) // 1000 * 1000 - 600000000 FROM events)""")
def stream_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows the watermark has passed at the end of the log."""
    folder = scratch(spark, "throughput")
    stream = source.stream_change_log(spark, landed_in_order(spark, events_log(spark, sf_dir), folder), max_files=width(spark))
    counted = source.windowed(stream, "1 hour")
    drained(counted.writeStream.format("parquet").option("path", f"{folder}/out"), folder)
    return spark.read.parquet(f"{folder}/out").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n")


@query("stream_sessions", """
WITH p AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR epoch_us(ts) - epoch_us(prev) > 7200000000 THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sess FROM p),
g AS (SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n FROM s GROUP BY user_id, sess)
SELECT user_id, session_start, n FROM g
WHERE epoch_us(session_end) + 7200000000 <= (SELECT max(epoch_us(ts)) // 1000 * 1000 - 600000000 FROM events)""")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of users that the watermark has closed at the end of the log."""
    folder = scratch(spark, "sessions")
    stream = source.stream_change_log(spark, landed_in_order(spark, events_log(spark, sf_dir), folder), max_files=width(spark))
    user = F.coalesce(stated(F.col("keys"), "user_id")["long_val"], stated(F.col("new_data"), "user_id")["long_val"])
    rows = with_message_time(stream).select(user.alias("user_id"), "msg_ts")
    counted = source.sessions(rows, ["user_id"], "msg_ts", "2 hours")
    drained(counted.writeStream.format("parquet").option("path", f"{folder}/out"), folder)
    return spark.read.parquet(f"{folder}/out").select(
        "user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), "n")
