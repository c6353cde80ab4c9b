"""Catalogue entries of replay, lineage and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.types import Field
from tidemark.operators import generations, lineage, replay, stats, versions
from tidemark.plans import logs_sql as sql
from tidemark.plans.derive import DB, EVENT_FIELDS, ORDER_FIELDS, events_log, field_list, orders_log, table
from tidemark.plans.records import orders_and_ddl, whole_log
from tidemark.plans.registry import ORACLE, query
from tidemark.schema import conform

ORDER_KEY = ["o_orderkey"]
USER_KEY = ["user_id"]


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.row_changes(orders_log(spark, sf_dir), ORDER_FIELDS, ORDER_KEY)


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.row_changes(events_log(spark, sf_dir), EVENT_FIELDS, USER_KEY)


def odd_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A base table for replay: every second order, at double price."""
    return table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 2 == 1).withColumn(
        "o_totalprice", F.col("o_totalprice") * 2)


# State of an order after the whole log: deleted keys (%7 but not re-inserted) are gone; updates of phase 2 and 3 hold
# unless the key was re-inserted in phase 5; the late update of phase 6 applies to live keys only.
_STATE_SQL = """
state AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 35 = 0 AND (o_orderkey % 7 <> 0 OR o_orderkey % 21 = 0) THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
    CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 21 <> 0 THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderkey % 9 = 0 AND o_orderkey % 21 <> 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
    o_orderdate,
    CASE WHEN o_orderkey % 6 = 0 AND o_orderkey % 21 <> 0 THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderkey % 7 <> 0 OR o_orderkey % 21 = 0
)"""


@query("net_changes", f"""
WITH {sql.O_LOG}, n AS (SELECT o_orderkey, count(*) AS n_changes, max(tx_seq) AS last_tx FROM o_log GROUP BY o_orderkey)
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 AND o_orderkey % 21 <> 0 THEN 'D' ELSE 'I' END AS op, n_changes, last_tx FROM n""")
def net_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.net_changes(order_changes(spark, sf_dir), ORDER_KEY).select("o_orderkey", "op", "n_changes", "last_tx")


@query("replay_apply", f"WITH {_STATE_SQL} SELECT * FROM state")
def replay_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = table(spark, sf_dir, "orders").limit(0)
    return replay.replay(empty, orders_log(spark, sf_dir), ORDER_FIELDS, ORDER_KEY)


@query("replay_apply_updates", """
WITH base AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 2 = 1)
SELECT o_orderkey, CASE WHEN o_orderkey % 35 = 0 AND o_orderkey % 7 <> 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
  CASE WHEN o_orderkey % 3 = 0 THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
FROM base WHERE o_orderkey % 7 <> 0""")
def replay_apply_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the updates and deletes, onto a base table that has half of their keys."""
    log = orders_log(spark, sf_dir).filter(F.col("op_type") != "I")
    return replay.replay(odd_orders(spark, sf_dir), log, ORDER_FIELDS, ORDER_KEY)


@query("replay_events", """
WITH e AS (SELECT *, max(CASE WHEN event_type IN ('signup', 'error') THEN event_id END) OVER (PARTITION BY user_id) AS reset FROM events),
k AS (SELECT user_id, max(reset) AS reset FROM e GROUP BY user_id),
live AS (SELECT k.* FROM k JOIN events e ON e.event_id = k.reset WHERE e.event_type = 'signup')
SELECT l.user_id,
  (SELECT arg_max(e.value, e.event_id) FROM events e WHERE e.user_id = l.user_id AND e.event_id >= l.reset AND e.event_type NOT IN ('click', 'error')) AS value,
  (SELECT arg_max(e.props, e.event_id) FROM events e WHERE e.user_id = l.user_id AND e.event_id >= l.reset AND e.event_type NOT IN ('view', 'error')) AS props
FROM live l""")
def replay_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = spark.createDataFrame([], "user_id bigint, value double, props string")
    return replay.replay(empty, events_log(spark, sf_dir), EVENT_FIELDS, USER_KEY)


@query("rows_touched", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 35 = 0")
def rows_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = order_changes(spark, sf_dir).filter(F.col("op") != "I")
    return replay.rows_touched(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), changes, ORDER_KEY)


@query("rows_untouched", "SELECT o_orderkey, o_custkey FROM orders WHERE NOT (o_orderkey % 3 = 0 OR o_orderkey % 7 = 0)")
def rows_untouched(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = order_changes(spark, sf_dir).filter(F.col("op") != "I")
    return replay.rows_untouched(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), changes, ORDER_KEY)


_CONFLICTS_SQL = """
SELECT {key}, tx_seq, op_type AS op, CASE op_type WHEN 'I' THEN 'insert_exists' WHEN 'U' THEN 'update_missing' ELSE 'delete_missing' END AS reason
FROM (SELECT *, last_value(CASE WHEN op_type IN ('I', 'D') THEN op_type END IGNORE NULLS) OVER (
    PARTITION BY {key} ORDER BY tx_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM {log})
WHERE (op_type = 'I') = (coalesce(prev, 'D') = 'I')"""


@query("replay_conflicts", f"WITH {sql.O_LOG} {_CONFLICTS_SQL.format(key='o_orderkey', log='o_log')}")
def replay_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.replay_conflicts(order_changes(spark, sf_dir), ORDER_KEY).select("o_orderkey", "tx_seq", "op", "reason")


@query("replay_conflicts_events", f"WITH {sql.E_LOG} {_CONFLICTS_SQL.format(key='user_id', log='e_log')}")
def replay_conflicts_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.replay_conflicts(user_changes(spark, sf_dir), USER_KEY).select("user_id", "tx_seq", "op", "reason")


@query("replay_conflicts_split", ORACLE["replay_conflicts_events"])
def replay_conflicts_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a low limit for busy keys, so that users take the split path."""
    return replay.replay_conflicts(user_changes(spark, sf_dir), USER_KEY, hot_rows=60).select(
        "user_id", "tx_seq", "op", "reason")


@query("replay_conflicts_base", f"""
WITH {sql.O_LOG} SELECT o_orderkey, tx_seq, op_type AS op,
  CASE op_type WHEN 'U' THEN 'update_missing' WHEN 'D' THEN 'delete_missing' ELSE 'insert_exists' END AS reason
FROM o_log WHERE (phase = 1 AND o_orderkey % 2 = 1) OR (phase = 6 AND o_orderkey % 21 <> 0)""")
def replay_conflicts_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.replay_conflicts(order_changes(spark, sf_dir), ORDER_KEY, odd_orders(spark, sf_dir)).select(
        "o_orderkey", "tx_seq", "op", "reason")


_HISTORY_SQL = f"""
WITH {sql.E_LOG},
g AS (SELECT *, count(*) FILTER (op_type IN ('I', 'D')) OVER w AS gen,
    last_value(CASE WHEN op_type IN ('I', 'D') THEN op_type END IGNORE NULLS) OVER w AS state
  FROM e_log WINDOW w AS (PARTITION BY user_id ORDER BY tx_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
h AS (SELECT user_id, tx_seq, op_type AS op, state,
    last_value(CASE WHEN event_type NOT IN ('click', 'error') THEN value END IGNORE NULLS) OVER w AS value,
    last_value(CASE WHEN event_type NOT IN ('view', 'error') THEN props END IGNORE NULLS) OVER w AS props
  FROM g WINDOW w AS (PARTITION BY user_id, gen ORDER BY tx_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@query("row_history", f"{_HISTORY_SQL} SELECT user_id, tx_seq, op, value, props FROM h WHERE state = 'I'")
def row_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.row_history(user_changes(spark, sf_dir), USER_KEY).select("user_id", "tx_seq", "op", "value", "props")


@query("row_history_orders", f"""
WITH {sql.O_LOG}
SELECT o_orderkey, tx_seq, CASE WHEN phase = 6 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
  CASE WHEN o_orderkey % 3 = 0 AND (phase IN (2, 3) OR (phase = 6 AND o_orderkey % 21 <> 0)) THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 9 = 0 AND (phase IN (2, 3) OR (phase = 6 AND o_orderkey % 21 <> 0)) THEN NULL ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 6 = 0 AND (phase = 3 OR (phase = 6 AND o_orderkey % 21 <> 0)) THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority
FROM o_log WHERE op_type <> 'D' AND NOT (phase = 6 AND o_orderkey % 21 <> 0)""")
def row_history_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.row_history(order_changes(spark, sf_dir), ORDER_KEY).select(
        "o_orderkey", "tx_seq", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query("before_image", f"""{_HISTORY_SQL},
p AS (SELECT user_id, tx_seq, op, lag(state) OVER w AS was, lag(value) OVER w AS value, lag(props) OVER w AS props
  FROM h WINDOW w AS (PARTITION BY user_id ORDER BY tx_seq))
SELECT user_id, tx_seq, op, value, props FROM p WHERE op <> 'I' AND was = 'I'""")
def before_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.before_images(user_changes(spark, sf_dir), USER_KEY).select("user_id", "tx_seq", "op", "value", "props")


@query("before_image_split", ORACLE["before_image"])
def before_image_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a low limit for busy keys, so that users take the split path."""
    return replay.before_images(user_changes(spark, sf_dir), USER_KEY, hot_rows=60).select(
        "user_id", "tx_seq", "op", "value", "props")


@query("reconcile", f"""
WITH {_STATE_SQL}
SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 1 THEN 'missing' ELSE 'different' END AS side
FROM state WHERE o_orderkey % 50 IN (1, 2)
UNION ALL SELECT o_orderkey, 'extra' FROM orders WHERE o_orderkey % 7 = 0 AND o_orderkey % 21 <> 0 AND o_orderkey % 2 = 0""")
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replayed orders with differences put in, against the replayed orders."""
    k = F.col("o_orderkey")
    expected = replay_apply(spark, sf_dir)
    gone = table(spark, sf_dir, "orders").filter((k % 7 == 0) & (k % 21 != 0) & (k % 2 == 0))
    damaged = expected.filter(k % 50 != 1).withColumn(
        "o_custkey", F.when(k % 50 == 2, F.lit(-1).cast("long")).otherwise(F.col("o_custkey")))
    return replay.reconcile(damaged.unionByName(gone), expected, ORDER_KEY)


@query("schema_asof", f"""
WITH {sql.OD_LOG}
SELECT tx_seq, op_type, ddl_tx_seq FROM (
  SELECT *, last_value(CASE WHEN op_type = 'DDL' THEN tx_seq END IGNORE NULLS) OVER (PARTITION BY db_name, table_ ORDER BY {sql.ORDERED}
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ddl_tx_seq FROM od_log WHERE table_ IS NOT NULL)
WHERE op_type <> 'DDL'""")
def schema_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.schema_asof(orders_and_ddl(spark, sf_dir)).select("tx_seq", "op_type", "ddl_tx_seq")


@query("commit_gaps", f"""
WITH {sql.O_LOG}, p AS (SELECT dn, tx_seq, last_commit, lag(tx_seq) OVER (PARTITION BY dn ORDER BY {sql.ORDERED}) AS prev_tx_seq FROM o_log)
SELECT dn, tx_seq, prev_tx_seq, last_commit - prev_tx_seq AS gap FROM p""")
def commit_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.commit_gaps(orders_log(spark, sf_dir)).select("dn", "tx_seq", "prev_tx_seq", "gap")


@query("commit_gaps_split", ORACLE["commit_gaps"])
def commit_gaps_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a low limit: each of the four sources is cut into ranges, as it would be at scale."""
    return lineage.commit_gaps(orders_log(spark, sf_dir), hot_rows=1000).select("dn", "tx_seq", "prev_tx_seq", "gap")


@query("commit_groups", f"""
WITH {sql.E_LOG} SELECT last_commit, count(*) AS n, min(tx_seq) AS first_tx, max(tx_seq) AS last_tx FROM e_log GROUP BY last_commit""")
def commit_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.commit_groups(events_log(spark, sf_dir))


@query("table_ids", f"""
WITH {sql.ALL_LOG},
f AS (SELECT db_name, table_, scn, tx_seq, seq, lsn, dn, row_number() OVER (PARTITION BY db_name, table_ ORDER BY {sql.ORDERED}) AS rn
  FROM all_log WHERE table_ IS NOT NULL)
SELECT db_name, table_, row_number() OVER (ORDER BY {sql.ORDERED}) AS table_id FROM f WHERE rn = 1""")
def table_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.table_ids(whole_log(spark, sf_dir))


_SID_SQL = """
s AS (SELECT event_id, user_id, md5(user_id::VARCHAR) AS x FROM events),
sids AS (SELECT event_id, user_id, x[1:8] || '-' || x[9:12] || '-' || x[13:16] || '-' || x[17:20] || '-' || x[21:32] AS sid FROM s),
dict AS (SELECT sid, row_number() OVER (ORDER BY min(event_id)) AS sidno FROM sids GROUP BY sid)"""


def event_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.md5(F.col("user_id").cast("string").cast("binary"))
    return table(spark, sf_dir, "events").select("event_id", "user_id", F.upper(x).alias("sid"))


@query("sid_dictionary", f"WITH {_SID_SQL} SELECT sid, sidno FROM dict")
def sid_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.source_dictionary(event_sources(spark, sf_dir), F.struct("event_id"))


@query("sid_lookup", f"""
WITH {_SID_SQL}, first AS (SELECT sid, row_number() OVER (ORDER BY min(event_id)) AS sidno FROM sids WHERE user_id % 5 <> 0 GROUP BY sid)
SELECT event_id, coalesce(sidno, 0) AS sidno FROM sids LEFT JOIN first USING (sid)""")
def sid_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of every event against a dictionary that lacks a fifth of them."""
    sources = event_sources(spark, sf_dir)
    known = lineage.source_dictionary(sources.filter(F.col("user_id") % 5 != 0), F.struct("event_id"))
    return lineage.source_lookup(sources, known).select("event_id", "sidno")


@query("progress_counts", f"""
WITH {sql.ALL_LOG} SELECT db_name, table_, op_type, count(*) AS n_records,
  CAST(sum(CASE WHEN op_type = 'DDL' THEN 2 ELSE 5 END) AS BIGINT) AS n_events FROM all_log GROUP BY db_name, table_, op_type""")
def progress_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.progress_counts(whole_log(spark, sf_dir))


@query("volume_rollup", f"""
WITH {sql.ALL_LOG} SELECT db_name, table_, op_type, CAST(grouping_id(db_name, table_, op_type) AS INTEGER) AS level, count(*) AS n_records,
  CAST(sum(CASE WHEN op_type = 'DDL' THEN 2 ELSE 5 END) AS BIGINT) AS n_events FROM all_log GROUP BY ROLLUP (db_name, table_, op_type)""")
def volume_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.volume_rollup(whole_log(spark, sf_dir))


@query("column_change_stats", f"""
WITH {sql.O_LOG}, c(column_name, ordinal) AS (VALUES ('o_orderkey', 1), ('o_custkey', 2), ('o_orderstatus', 3),
  ('o_totalprice', 4), ('o_orderdate', 5), ('o_orderpriority', 6))
SELECT 'tpch' AS db_name, 'orders' AS table_, op_type, 'after' AS side, column_name, count(*) AS n_present,
  count(*) FILTER (phase = 2 AND column_name = 'o_totalprice') AS n_null FROM o_log, c
WHERE op_type = 'I' OR (phase = 2 AND (ordinal = 3 OR (ordinal = 4 AND o_orderkey % 9 = 0))) OR (phase = 3 AND ordinal = 6)
  OR (phase = 6 AND ordinal = 2) GROUP BY op_type, column_name
UNION ALL
SELECT 'tpch', 'orders', op_type, 'before', column_name, count(*), 0 FROM o_log, c
WHERE op_type <> 'I' AND (ordinal = 1 OR (phase = 2 AND ordinal = 3) OR (phase = 3 AND ordinal = 6)) GROUP BY op_type, column_name""")
def column_change_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.column_change_stats(orders_log(spark, sf_dir))


@query("throughput", """
SELECT make_timestamp(epoch_us(ts) // 3600000000 * 3600000000) AS window_start, count(*) AS n FROM events GROUP BY 1""")
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.throughput(events_log(spark, sf_dir), "1 hour").withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz"))


@query("throughput_sliding", """
SELECT make_timestamp((epoch_us(ts) // 900000000 - back) * 900000000) AS window_start, count(*) AS n
FROM events, (VALUES (0), (1), (2), (3)) AS b(back) GROUP BY 1""")
def throughput_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.throughput(events_log(spark, sf_dir), "1 hour", "15 minutes").withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz"))


@query("key_sessions", """
WITH p AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR epoch_us(ts) - epoch_us(prev) > 7200000000 THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sess FROM p)
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n FROM s GROUP BY user_id, sess""")
def key_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id")
    out = stats.key_sessions(rows, USER_KEY, "ts", ["event_id"], 7200)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


@query("hot_keys", """
SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 20""")
def hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.hot_rows_report(user_changes(spark, sf_dir), USER_KEY, 20)


@query("replay_with_definitions", """
SELECT o_orderkey, CASE WHEN o_orderkey % 35 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey, o_orderstatus, o_totalprice,
  o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 21 = 0""")
def replay_with_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders truncated between the deletes and the re-inserts; drops of another table and of other databases do not count."""
    tx = F.col("tx_seq")
    steps = spark.createDataFrame(
        [(4_999_999_999_999, DB, "orders", "TRUNCATE TABLE orders", None), (1, DB, "orders", "create table orders (x int)", "CREATE TABLE"),
         (6_999_999_999_997, DB, "lineitem", "drop table lineitem", "DROP TABLE"), (6_999_999_999_998, None, None, "drop database shop_1", None),
         (6_999_999_999_999, None, None, "drop procedure p", None)],
        "tx_seq bigint, db_name string, table_ string, ddl_sql string, ddl_type string")
    steps = conform(steps.withColumns({"scn": tx * 1000, "seq": F.lit(0), "lsn": tx, "op_type": F.lit("DDL")}))
    log = orders_log(spark, sf_dir).unionByName(steps)
    return replay.replay_table(odd_orders(spark, sf_dir), log, DB, "orders", ORDER_FIELDS, ORDER_KEY)


def defined_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders log with definitions between its phases: created first, truncated before phase 3, renamed away and back
    before phase 4 (its rows come along), dropped with another table before phase 5; the other definitions are of other
    tables. While it is renamed, phase 4 is told under the other name."""
    tx = F.col("tx_seq")
    steps = spark.createDataFrame(
        [(1, DB, "orders", "create table orders (x int)", "CREATE TABLE"), (2_999_999_999_998, DB, None, "truncate orders", None),
         (3_999_999_999_998, DB, "orders", "rename table `orders` to kept, lineitem to l2", None),
         (4_999_999_999_998, None, None, "rename table tpch.kept to tpch.orders", None),
         (4_999_999_999_999, DB, None, "drop table if exists part, customer", "DROP TABLE"),
         (5_999_999_999_998, None, None, "drop database `TPCH`", None), (6_999_999_999_998, None, None, "drop procedure orders", None)],
        "tx_seq bigint, db_name string, table_ string, ddl_sql string, ddl_type string")
    steps = conform(steps.withColumns({"scn": tx * 1000, "seq": F.lit(0), "lsn": tx, "op_type": F.lit("DDL")}))
    log = orders_log(spark, sf_dir)
    away = F.floor(F.col("tx_seq") / 1_000_000_000_000) == 4
    return log.withColumn("table_", F.when(away, "kept").otherwise(F.col("table_"))).unionByName(steps)


# Generations: phases 1-2 (before the truncation), 3-5 (through both renames), 6 (after the drop of the database)
_GENERATIONS_SQL = f"""
WITH {sql.O_LOG},
g AS (SELECT *, CASE WHEN phase <= 2 THEN 1 WHEN phase <= 5 THEN 2 ELSE 3 END AS generation FROM o_log),
r AS (SELECT *, last_value(CASE WHEN op_type IN ('I', 'D') THEN op_type END IGNORE NULLS) OVER (
    PARTITION BY o_orderkey, generation ORDER BY tx_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM g)"""


@query("definition_conflicts", f"""{_GENERATIONS_SQL}
SELECT o_orderkey, tx_seq, op_type AS op, CASE op_type WHEN 'I' THEN 'insert_exists' WHEN 'U' THEN 'update_missing' ELSE 'delete_missing' END AS reason
FROM r WHERE (op_type = 'I') = (coalesce(prev, 'D') = 'I')""")
def definition_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generations.replay_conflicts(defined_orders(spark, sf_dir), DB, "orders", ORDER_FIELDS, ORDER_KEY).select(
        "o_orderkey", "tx_seq", "op", "reason")


@query("definition_history", f"""{_GENERATIONS_SQL}
SELECT o_orderkey, tx_seq, o_custkey, CASE WHEN phase = 2 THEN 'F' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority
FROM r WHERE op_type = 'I' OR (op_type = 'U' AND prev = 'I')""")
def definition_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generations.row_history(defined_orders(spark, sf_dir), DB, "orders", ORDER_FIELDS, ORDER_KEY).select(
        "o_orderkey", "tx_seq", "o_custkey", "o_orderstatus", "o_orderpriority")


@query("definition_before_image", f"""{_GENERATIONS_SQL}
SELECT o_orderkey, tx_seq, op_type AS op, o_custkey, o_orderstatus FROM r WHERE op_type <> 'I' AND prev = 'I'""")
def definition_before_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generations.before_images(defined_orders(spark, sf_dir), DB, "orders", ORDER_FIELDS, ORDER_KEY).select(
        "o_orderkey", "tx_seq", "op", "o_custkey", "o_orderstatus")


@query("definition_replay", """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 21 = 0""")
def definition_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as of phase 5: inserted again after the truncation, dropped only later."""
    log = defined_orders(spark, sf_dir).filter(F.col("tx_seq") < 5_900_000_000_000)
    return generations.replay_table(odd_orders(spark, sf_dir), log, DB, "orders", ORDER_FIELDS, ORDER_KEY).select(
        "o_orderkey", "o_custkey", "o_orderstatus")


@query("table_definitions", f"""
WITH {sql.D_LOG}
SELECT tx_seq, CASE step WHEN 2 THEN 'create' WHEN 3 THEN 'drop' ELSE 'drop database' END AS kind, shop AS db,
  CASE WHEN step <> 4 THEN own END AS name FROM d_log JOIN d_steps USING (k, step, tx_seq) WHERE step IN (2, 3, 4)""")
def table_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which table every definition of the log creates or ends."""
    found = generations.definitions(orders_and_ddl(spark, sf_dir))
    return found.select(F.col("at.tx_seq").alias("tx_seq"), "kind", "db", "name")


def evolving_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders log with a field list that changes: until phase 2 without the date and with narrower customer keys, no
    list at all in phases 3 and 4, from phase 5 with the date, wider keys and no priority."""
    first = [Field("o_custkey", "INT") if f.name == "o_custkey" else f for f in ORDER_FIELDS if f.name != "o_orderdate"]
    second = [f for f in ORDER_FIELDS if f.name != "o_orderpriority"]
    phase = F.floor(F.col("tx_seq") / 1_000_000_000_000)
    listed = F.when(phase <= 2, field_list(first)).when(phase >= 5, field_list(second))
    return orders_log(spark, sf_dir).withColumn("fields", listed)


@query("typed_versions", f"""
WITH {sql.O_LOG}
SELECT tx_seq, CASE WHEN phase IN (1, 5) THEN o_orderkey END AS o_orderkey,
  CASE WHEN phase IN (1, 5) THEN o_custkey WHEN phase = 6 THEN o_custkey + 1 END AS o_custkey,
  CASE WHEN phase IN (1, 5) THEN o_orderstatus WHEN phase = 2 THEN 'F' END AS o_orderstatus,
  CASE WHEN phase IN (1, 5) THEN o_totalprice END AS o_totalprice, CASE WHEN phase = 5 THEN o_orderdate END AS o_orderdate,
  CASE phase WHEN 1 THEN o_orderpriority WHEN 3 THEN '1-URGENT' END AS o_orderpriority
FROM o_log""")
def typed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One typed row for each row change of a table whose columns come, go and are retyped."""
    return versions.typed_versions(evolving_orders(spark, sf_dir), DB, "orders", keep=("tx_seq",)).drop("version")


@query("field_versions", f"""
WITH {sql.O_LOG} SELECT phase >= 5 AS later, count(*) AS n_records, min(tx_seq) AS first_tx, max(tx_seq) AS last_tx
FROM o_log WHERE phase IN (1, 2, 5, 6) GROUP BY phase >= 5""")
def field_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = versions.field_versions(evolving_orders(spark, sf_dir))
    later = F.exists("fields", lambda f: f["name"] == "o_orderdate")
    return found.select(later.alias("later"), "n_records", F.col("first.tx_seq").alias("first_tx"), F.col("last.tx_seq").alias("last_tx"))
