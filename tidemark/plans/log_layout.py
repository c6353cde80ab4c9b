"""Catalogue entries of sizes, positions, batches and segments."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import ids
from tidemark.operators import events, rotation, segments
from tidemark.plans import logs_sql as sql
from tidemark.plans.derive import lineitem_log, orders_log, table
from tidemark.plans.records import orders_and_ddl
from tidemark.plans.registry import ORACLE, query
from tidemark.session import shared_dir
from tidemark.sources.change_log import union_logs

SEGMENT = 1_048_576

# Event lengths worked out by hand from the two table layouts (database 'tpch'). A row image takes its presence and
# NULL maps and its values: 8 for bigint and double, 5 for datetime, 4 for int, float and timestamp, 6 for decimal(12,2),
# 1 + n for short strings.
_O_LENS = """
o_len AS (
  SELECT *, CASE WHEN immediate_us = original_us THEN 73 ELSE 80 END AS e1, 42 AS e2, 55 AS e3,
    30 + CASE phase
      WHEN 2 THEN 2 + 8 + 1 + strlen(o_orderstatus) + 2 + 2
      WHEN 3 THEN 2 + 8 + 1 + strlen(o_orderpriority) + 2 + 9
      WHEN 4 THEN 10 WHEN 6 THEN 10 + 10
      ELSE 2 + 8 + 8 + 1 + strlen(o_orderstatus) + 8 + 5 + 1 + strlen(o_orderpriority) END AS e4, 27 AS e5
  FROM o_log
)"""
_L_LENS = """
l_len AS (
  SELECT *, CASE WHEN immediate_us = original_us THEN 73 ELSE 80 END AS e1, 42 AS e2, 67 AS e3,
    30 + 4 + 8 + 4 + 8 + 8 + 6 + 8 + 8 + 4 + 1 + strlen(l_returnflag) + 1 + strlen(l_linestatus) + 4 AS e4, 27 AS e5
  FROM l_log
)"""
_D_LENS = """
d_len AS (
  SELECT *, CASE WHEN immediate_us = original_us THEN 73 ELSE 80 END AS e1,
    33 + CASE WHEN db_name IS NULL THEN 43 ELSE 45 + 2 * strlen(db_name) END + strlen(ddl_sql) AS e2 FROM d_log
)"""


def _unpivot(name: str, keep: str) -> str:
    return f"""SELECT {keep}, ord AS event_ord,
      CAST(CASE ord WHEN 1 THEN e1 WHEN 2 THEN e2 WHEN 3 THEN e3 WHEN 4 THEN e4 ELSE e5 END AS BIGINT) AS event_len
    FROM {name}, (VALUES (1), (2), (3), (4), (5)) AS o(ord)"""


_L_EVENTS = f"""{sql.L_LOG},{_L_LENS},
l_ev AS ({_unpivot('l_len', 'scn, tx_seq, seq, lsn, dn, check_point')}),
l_pos AS (SELECT *, CAST(sum(event_len) OVER (ORDER BY {sql.ORDERED}, event_ord ROWS UNBOUNDED PRECEDING) AS BIGINT) AS end_pos,
  row_number() OVER (ORDER BY {sql.ORDERED}, event_ord) AS rn FROM l_ev)"""
_L_QUOTA = f"{_L_EVENTS},\nl_seg AS (SELECT *, (end_pos - 1) // {SEGMENT} + 1 AS segment_no FROM l_pos)"


@query("event_size", f"""
WITH {sql.O_LOG},{sql.L_LOG},{_O_LENS},{_L_LENS}
{_unpivot('o_len', "'orders' AS table_, tx_seq, seq")} UNION ALL {_unpivot('l_len', "'lineitem' AS table_, tx_seq, seq")}""")
def event_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = union_logs(orders_log(spark, sf_dir), lineitem_log(spark, sf_dir))
    return events.sized_events(log, ("table_", "tx_seq", "seq"))


@query("ddl_event_size", f"""
WITH {sql.D_LOG},{_D_LENS}
SELECT tx_seq, seq, ord AS event_ord, CAST(CASE ord WHEN 1 THEN e1 ELSE e2 END AS BIGINT) AS event_len
FROM d_len, (VALUES (1), (2)) AS o(ord)""")
def ddl_event_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = orders_and_ddl(spark, sf_dir).filter(F.col("op_type") == "DDL")
    return events.sized_events(log, ("tx_seq", "seq"))


@query("txn_bytes", f"""
WITH {sql.L_LOG},{_L_LENS}
SELECT tx_seq, CAST(sum(e1 + e2 + e3 + e4 + e5) AS BIGINT) AS bytes, count(*) AS n_records FROM l_len GROUP BY tx_seq""")
def txn_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.transaction_bytes(lineitem_log(spark, sf_dir))


@query("log_position", f"WITH {_L_EVENTS} SELECT tx_seq, seq, lsn, event_ord, event_len, end_pos FROM l_pos")
def log_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.log_positions(lineitem_log(spark, sf_dir)).select("tx_seq", "seq", "lsn", "event_ord", "event_len", "end_pos")


@query("event_header", f"""
WITH {sql.O_LOG},{_O_LENS},
ev AS ({_unpivot('o_len', 'scn, tx_seq, seq, lsn, dn, op_type, immediate_us')})
SELECT tx_seq, event_ord, immediate_us // 1000000 AS commit_second, CAST(100 AS INTEGER) AS server_id, event_len,
  CASE event_ord WHEN 1 THEN 33 WHEN 2 THEN 2 WHEN 3 THEN 19 WHEN 5 THEN 16
    ELSE CASE op_type WHEN 'I' THEN 30 WHEN 'U' THEN 31 ELSE 32 END END AS event_code, CAST(0 AS INTEGER) AS flags,
  CAST(sum(event_len) OVER (ORDER BY {sql.ORDERED}, event_ord ROWS UNBOUNDED PRECEDING) AS BIGINT) AS end_pos FROM ev""")
def event_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.event_headers(orders_log(spark, sf_dir)).select(
        "tx_seq", "event_ord", "commit_second", "server_id", "event_len", "event_code", "flags", "end_pos")


@query("batch_numbers", f"""
WITH {sql.L_LOG}, r AS (SELECT tx_seq, (row_number() OVER (ORDER BY {sql.ORDERED}) - 1) // 4096 AS batch_no FROM l_log)
SELECT batch_no, count(*) AS n, min(tx_seq) AS first_tx, max(tx_seq) AS last_tx FROM r GROUP BY batch_no""")
def batch_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = lineitem_log(spark, sf_dir).select("scn", "tx_seq", "seq", "lsn", "dn")
    return segments.batch_numbers(narrow).groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n"), F.min("tx_seq").alias("first_tx"), F.max("tx_seq").alias("last_tx"))


def line_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.quota_segments(lineitem_log(spark, sf_dir), SEGMENT, ("check_point",))


def line_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.segments_of(line_events(spark, sf_dir))


_SEGMENTS_SQL = """SELECT segment_no, count(*) AS n_events, CAST(sum(event_len) AS BIGINT) AS bytes, min(tx_seq) AS first_tx,
  max(tx_seq) AS last_tx, arg_max(check_point, rn) AS check_point FROM {0} GROUP BY segment_no"""


@query("segments_quota", f"WITH {_L_QUOTA} {_SEGMENTS_SQL.format('l_seg')}")
def segments_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_segments(spark, sf_dir)


@query("segments_greedy", f"""
WITH RECURSIVE {_L_EVENTS},
total AS (SELECT max(rn) AS n FROM l_pos),
cuts(segment_no, first_rn, start_pos) AS (
  SELECT CAST(1 AS BIGINT), CAST(1 AS BIGINT), CAST(0 AS BIGINT)
  UNION ALL
  SELECT c.segment_no + 1, p.rn, p.end_pos - p.event_len FROM cuts c JOIN l_pos p
    ON p.rn = (SELECT min(q.rn) FROM l_pos q WHERE q.rn > c.first_rn AND 122 + q.end_pos - c.start_pos + 200 >= {SEGMENT})
),
spans AS (SELECT segment_no, first_rn, start_pos, lead(first_rn) OVER (ORDER BY segment_no) AS next_rn FROM cuts),
placed AS (SELECT p.*, s.segment_no, 122 + p.end_pos - s.start_pos AS segment_pos
  FROM l_pos p JOIN spans s ON p.rn >= s.first_rn AND (s.next_rn IS NULL OR p.rn < s.next_rn))
SELECT segment_no, count(*) AS n_events, CAST(sum(event_len) AS BIGINT) AS bytes, max(segment_pos) AS used,
  max(tx_seq) AS last_tx, arg_max(check_point, rn) AS check_point FROM placed GROUP BY segment_no""")
def segments_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _used(segments.greedy_segments(lineitem_log(spark, sf_dir), SEGMENT, keep=("check_point",)))


def _used(placed: DataFrame) -> DataFrame:
    return placed.groupBy("segment_no").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("event_len").alias("bytes"), F.max("segment_pos").alias("used"),
        F.max("tx_seq").alias("last_tx"),
        F.max_by("check_point", F.struct("scn", "tx_seq", "seq", "lsn", "dn", "event_ord")).alias("check_point"))


def resumed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of a folder that three runs have written, each from where the one before stopped."""
    log = lineitem_log(spark, sf_dir)
    path = f"{shared_dir(spark).rstrip('/')}/rotation-{uuid.uuid4().hex}"
    low, high = log.agg(F.min("tx_seq"), F.max("tx_seq")).first()
    for share in (0.2, 0.7, 1):
        seen = log.filter(F.col("tx_seq") <= low + int((high - low) * share)) if low is not None else log
        rotation.append_segments(rotation.not_yet_written(seen, rotation.rotation_state(spark, path)), path, SEGMENT)
    return rotation.read_rotation(spark, path)


@query("segments_resumed", ORACLE["segments_greedy"])
def segments_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _used(resumed_events(spark, sf_dir))


@query("segments_resumed_chain", f"""
SELECT g.segment_no, printf('ON.%06d', g.segment_no) AS name, CASE WHEN g.segment_no < t.n THEN printf('ON.%06d', g.segment_no + 1) END AS next_name,
  'SUCCESS' AS status, split_part(check_point, '-', 1)::BIGINT AS tx_seq, g.segment_no > floor(t.n * 0.3) AS keep
FROM ({ORACLE["segments_greedy"]}) g, (SELECT max(segment_no) AS n FROM ({ORACLE["segments_greedy"]})) t""")
def segments_resumed_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, pointers, status and retention of the segments that several runs have written."""
    known = segments.segments_of(resumed_events(spark, sf_dir))
    chain = segments.segment_chain(known).select("segment_no", "name", "next_name")
    status = segments.segment_status(chain.select("name"), known).select("name", "status", F.col("tx_seq").cast("long").alias("tx_seq"))
    kept = segments.retention(known).select("segment_no", "keep")
    return chain.join(status, "name").join(kept, "segment_no").select("segment_no", "name", "next_name", "status", "tx_seq", "keep")


@query("segment_index", f"WITH {_L_QUOTA} SELECT DISTINCT segment_no, printf('ON.%06d', segment_no) AS name FROM l_seg")
def segment_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.segment_index(line_events(spark, sf_dir))


@query("segment_chain", f"""
WITH {_L_QUOTA}, d AS (SELECT DISTINCT segment_no FROM l_seg), n AS (SELECT segment_no, lead(segment_no) OVER (ORDER BY segment_no) AS nxt FROM d)
SELECT segment_no, printf('ON.%06d', segment_no) AS name, CASE WHEN nxt IS NOT NULL THEN printf('ON.%06d', nxt) END AS next_name,
  CASE WHEN nxt IS NOT NULL THEN CAST(4 AS INTEGER) END AS next_position, CASE WHEN nxt IS NOT NULL THEN CAST(36 AS INTEGER) END AS pointer_len FROM n""")
def segment_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.segment_chain(line_events(spark, sf_dir))


_NAMES_SQL = """
names AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN printf('ON.%06d', o_orderkey // 6) WHEN 1 THEN 'ON.index'
  WHEN 2 THEN 'XX.' || o_orderkey::VARCHAR WHEN 3 THEN 'ON.' || (o_orderkey // 6)::VARCHAR
  WHEN 4 THEN printf('ON.%07d.bak', 1000000 + o_orderkey) ELSE 'ON' END AS name FROM orders)"""


def made_up_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr("""CASE o_orderkey % 6
        WHEN 0 THEN format_string('ON.%06d', o_orderkey div 6) WHEN 1 THEN 'ON.index'
        WHEN 2 THEN concat('XX.', o_orderkey) WHEN 3 THEN concat('ON.', o_orderkey div 6)
        WHEN 4 THEN format_string('ON.%07d.bak', 1000000 + o_orderkey) ELSE 'ON' END""").alias("name"))


@query("segment_names", f"""
WITH {_NAMES_SQL} SELECT o_orderkey, name, CASE o_orderkey % 6 WHEN 0 THEN o_orderkey // 6 WHEN 3 THEN o_orderkey // 6
  WHEN 4 THEN 1000000 + o_orderkey END AS segment_no, o_orderkey % 6 IN (0, 3, 4) AS valid FROM names""")
def segment_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = ids.segment_number(F.col("name"))
    return made_up_names(spark, sf_dir).select("o_orderkey", "name", number.alias("segment_no"), number.isNotNull().alias("valid"))


@query("segment_catalog", f"""
WITH {_NAMES_SQL}, n AS (SELECT name, CASE o_orderkey % 6 WHEN 0 THEN o_orderkey // 6 WHEN 3 THEN o_orderkey // 6
  WHEN 4 THEN 1000000 + o_orderkey END AS segment_no FROM names)
SELECT segment_no, min(name) AS name FROM n WHERE segment_no IS NOT NULL GROUP BY segment_no""")
def segment_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.segment_catalog(made_up_names(spark, sf_dir))


@query("segment_status", f"""
WITH {_L_QUOTA},{_NAMES_SQL},
s AS ({_SEGMENTS_SQL.format('l_seg')}),
c AS (SELECT segment_no, CASE WHEN segment_no % 5 = 0 THEN 'a-2-3' ELSE check_point END AS check_point FROM s),
n AS (SELECT o_orderkey, name, CASE o_orderkey % 6 WHEN 0 THEN o_orderkey // 6 WHEN 3 THEN o_orderkey // 6
  WHEN 4 THEN 1000000 + o_orderkey END AS segment_no FROM names)
SELECT name, CASE WHEN n.segment_no IS NULL THEN 'INVALID_ARGUMENT' WHEN c.segment_no IS NULL THEN 'FILE_NOT_EXIST'
    WHEN check_point = 'a-2-3' THEN 'INVALID_CHECKPOINT' ELSE 'SUCCESS' END AS status,
  CASE WHEN check_point <> 'a-2-3' THEN string_split(check_point, '-')[1] END AS tx_seq,
  CASE WHEN check_point <> 'a-2-3' THEN CAST(string_split(check_point, '-')[2] AS BIGINT) END AS seq,
  CASE WHEN check_point <> 'a-2-3' THEN string_split(check_point, '-')[3] END AS scn
FROM n LEFT JOIN c ON n.segment_no = c.segment_no""")
def segment_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of many names, valid or not, against segments of which every fifth has a damaged checkpoint."""
    damaged = line_segments(spark, sf_dir).withColumn(
        "check_point", F.when(F.col("segment_no") % 5 == 0, "a-2-3").otherwise(F.col("check_point")))
    return segments.segment_status(made_up_names(spark, sf_dir), damaged).select(
        "name", "status", F.col("tx_seq").cast("string").alias("tx_seq"), "seq", F.col("scn").cast("string").alias("scn"))


@query("resume_segment", f"""
WITH {_L_QUOTA} SELECT segment_no AS last_segment, CAST(sum(event_len) + 122 AS BIGINT) AS used_bytes FROM l_seg
WHERE segment_no = (SELECT max(segment_no) FROM l_seg) GROUP BY segment_no""")
def resume_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.resume_point(line_events(spark, sf_dir))


@query("segment_retention", f"""
WITH {_L_QUOTA}, d AS (SELECT DISTINCT segment_no FROM l_seg),
r AS (SELECT segment_no, row_number() OVER (ORDER BY segment_no) AS rn, count(*) OVER () AS n FROM d)
SELECT segment_no, NOT (rn <= floor(n * 0.3)) AS keep FROM r""")
def segment_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.retention(line_events(spark, sf_dir).select("segment_no").distinct())


@query("write_segments", f"WITH {_L_QUOTA} SELECT segment_no, count(*) AS n_events, CAST(sum(event_len) AS BIGINT) AS bytes FROM l_seg GROUP BY segment_no")
def write_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments written to the shared folder and read back."""
    path = f"{shared_dir(spark)}/segments-{spark.sparkContext.applicationId}-{spark.sql('SELECT uuid()').first()[0]}"
    segments.write_segments(line_events(spark, sf_dir), path)
    return segments.read_segments(spark, path).groupBy("segment_no").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("event_len").alias("bytes"))
