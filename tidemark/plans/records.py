"""Catalogue entries of scans, projections, images and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import types
from tidemark.operators import events, images, normalize
from tidemark.operators.images import stated
from tidemark.operators.scans import numbered
from tidemark.plans import logs_sql as sql
from tidemark.plans.derive import (
    EVENT_FIELDS, LINEITEM_FIELDS, ORDER_FIELDS, ddl_log, events_log, kv, lineitem_log, orders_log)
from tidemark.plans.registry import query
from tidemark.schema import commit_order
from tidemark.sources import change_log as source


def orders_and_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.union_logs(orders_log(spark, sf_dir), ddl_log(spark, sf_dir))


def whole_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.union_logs(orders_log(spark, sf_dir), lineitem_log(spark, sf_dir), events_log(spark, sf_dir),
                             ddl_log(spark, sf_dir))


@query("scan_change_log", f"""
WITH {sql.OD_LOG}
SELECT tx_seq, op_type, table_, CAST(CASE WHEN op_type = 'DDL' THEN 0 ELSE 6 END AS INTEGER) AS n_fields,
  CAST(CASE WHEN op_type = 'I' THEN 6 WHEN op_type = 'U' THEN
    CASE WHEN tx_seq // 1000000000000 = 2 AND tx_seq % 1000000000000 % 9 = 0 THEN 2 ELSE 1 END ELSE 0 END AS INTEGER) AS n_new
FROM od_log""")
def scan_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_and_ddl(spark, sf_dir).select(
        "tx_seq", "op_type", "table_", F.coalesce(F.size("fields"), F.lit(0)).alias("n_fields"),
        F.coalesce(F.size("new_data"), F.lit(0)).alias("n_new"))


@query("shuffle_by_table", f"""
WITH {sql.ALL_LOG}
SELECT db_name, table_, count(*) AS n_records, min(tx_seq) AS first_tx, max(tx_seq) AS last_tx
FROM all_log GROUP BY db_name, table_""")
def shuffle_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = whole_log(spark, sf_dir).select("db_name", "table_", "scn", "tx_seq", "seq", "lsn", "dn")
    return source.by_table(narrow).groupBy("db_name", "table_").agg(
        F.count(F.lit(1)).alias("n_records"), F.min("tx_seq").alias("first_tx"), F.max("tx_seq").alias("last_tx"))


@query("route_ddl_dml", f"WITH {sql.OD_LOG} SELECT op_type = 'DDL' AS is_ddl, count(*) AS n FROM od_log GROUP BY 1")
def route_ddl_dml(spark: SparkSession, sf_dir: str) -> DataFrame:
    ddl, dml = source.route(orders_and_ddl(spark, sf_dir))
    return ddl.agg(F.count(F.lit(1)).alias("n")).select(F.lit(True).alias("is_ddl"), "n").unionAll(
        dml.agg(F.count(F.lit(1)).alias("n")).select(F.lit(False).alias("is_ddl"), "n"))


@query("skip_take", f"WITH {sql.O_LOG} SELECT tx_seq, op_type FROM o_log ORDER BY {sql.ORDERED} LIMIT 50 OFFSET 100")
def skip_take(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.skip_take(orders_log(spark, sf_dir), 100, 50).select("tx_seq", "op_type")


@query("skip_take_far", f"""
WITH {sql.O_LOG}, t AS (SELECT tx_seq, op_type, row_number() OVER (ORDER BY {sql.ORDERED}) AS rn FROM o_log)
SELECT tx_seq, op_type FROM t WHERE rn BETWEEN 12001 AND 14000""")
def skip_take_far(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = orders_log(spark, sf_dir).select("scn", "tx_seq", "seq", "lsn", "dn", "op_type")
    return source.skip_take(narrow, 12_000, 2_000).select("tx_seq", "op_type")


@query("ddl_events", f"""
WITH {sql.D_LOG} SELECT tx_seq, seq, ord AS event_ord, CASE ord WHEN 1 THEN 'GTID' ELSE 'QUERY' END AS event_type
FROM d_log, (VALUES (1), (2)) AS o(ord)""")
def ddl_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.ddl_events(ddl_log(spark, sf_dir)).select("tx_seq", "seq", "event_ord", "event_type")


_DML_KIND = """CASE ord WHEN 1 THEN 'GTID' WHEN 2 THEN 'QUERY' WHEN 3 THEN 'TABLE_MAP' WHEN 5 THEN 'XID'
    ELSE CASE op_type WHEN 'I' THEN 'WRITE_ROWS' WHEN 'U' THEN 'UPDATE_ROWS' ELSE 'DELETE_ROWS' END END"""


@query("dml_events", f"""
WITH {sql.O_LOG} SELECT tx_seq, ord AS event_ord, {_DML_KIND} AS event_type,
  CASE ord WHEN 1 THEN 33 WHEN 2 THEN 2 WHEN 3 THEN 19 WHEN 5 THEN 16
    ELSE CASE op_type WHEN 'I' THEN 30 WHEN 'U' THEN 31 ELSE 32 END END AS event_code
FROM o_log, (VALUES (1), (2), (3), (4), (5)) AS o(ord)""")
def dml_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.dml_events(orders_log(spark, sf_dir)).select("tx_seq", "event_ord", "event_type", "event_code")


@query("all_events", f"""
WITH {sql.OD_LOG}
SELECT tx_seq, op_type, ord AS event_ord, {_DML_KIND} AS event_type
FROM od_log, (VALUES (1), (2), (3), (4), (5)) AS o(ord) WHERE op_type <> 'DDL' OR ord <= 2""")
def all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.explode_events(orders_and_ddl(spark, sf_dir)).select("tx_seq", "op_type", "event_ord", "event_type")


@query("change_events", f"""
WITH {sql.OD_LOG}
SELECT tx_seq, op_type, ord AS event_ord, immediate_us // 1000000 AS commit_second, CAST(100 AS INTEGER) AS server_id,
  CASE WHEN ord = 1 THEN last_commit END AS last_committed,
  CASE WHEN ord = 2 THEN CASE WHEN op_type = 'DDL' THEN ddl_sql ELSE 'BEGIN' END END AS statement,
  CASE WHEN ord = 3 THEN CAST(6 AS INTEGER) END AS n_columns,
  CASE WHEN ord = 4 THEN CAST(CASE WHEN op_type = 'I' THEN 6 WHEN op_type = 'U' THEN
    CASE WHEN tx_seq // 1000000000000 = 2 AND tx_seq % 1000000000000 % 9 = 0 THEN 2 ELSE 1 END ELSE 0 END AS INTEGER) END AS n_new,
  CASE WHEN ord = 5 THEN tx_seq END AS xid
FROM od_log, (VALUES (1), (2), (3), (4), (5)) AS o(ord) WHERE op_type <> 'DDL' OR ord <= 2""")
def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = events.change_events(orders_and_ddl(spark, sf_dir))
    return out.select(
        "tx_seq", "op_type", "event_ord", "commit_second", "server_id", F.col("gtid.last_committed").alias("last_committed"),
        F.col("query.sql").alias("statement"), F.col("table_map.n_columns").alias("n_columns"),
        F.when(F.col("rows").isNotNull(), F.coalesce(F.size("rows.new_data"), F.lit(0))).alias("n_new"), "xid")


@query("classify_ddl", f"""
WITH {sql.D_LOG}
SELECT tx_seq, seq, ddl_sql, CASE WHEN ddl_type IS NULL THEN 'drop db / procedure / function'
  WHEN ddl_type = 'CREATE TABLE' AND db_name IS NULL THEN 'create db' WHEN ddl_type = 'CREATE TABLE' THEN 'create table'
  WHEN ddl_type = 'DROP TABLE' THEN 'drop table' ELSE 'other' END AS class FROM d_log""")
def classify_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ddl_log(spark, sf_dir).select("tx_seq", "seq", "ddl_sql", normalize.ddl_class().alias("class"))


@query("decode_op", f"""
WITH {sql.O_LOG} SELECT tx_seq, op_type, CASE op_type WHEN 'I' THEN 30 WHEN 'U' THEN 31 WHEN 'D' THEN 32 END AS event_code
FROM o_log""")
def decode_op(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.decode_ops(orders_log(spark, sf_dir)).select("tx_seq", "op_type", "event_code")


@query("gtid_projection", f"""
WITH {sql.O_LOG} SELECT tx_seq, 'ANONYMOUS' AS kind, last_commit AS last_committed, immediate_us,
  CASE WHEN original_us <> immediate_us THEN original_us END AS original_us, CAST(80032 AS INTEGER) AS server_version FROM o_log""")
def gtid_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = normalize.commit_times(orders_log(spark, sf_dir)).select("tx_seq", events.gtid_payload().alias("g"))
    return timed.select("tx_seq", "g.kind", "g.last_committed", "g.immediate_us", "g.original_us", "g.server_version")


@query("query_projection", f"""
WITH {sql.OD_LOG} SELECT tx_seq, op_type, db_name, CASE WHEN op_type = 'DDL' THEN ddl_sql ELSE 'BEGIN' END AS sql,
  CASE WHEN op_type = 'DDL' THEN tx_seq END AS xid, CAST(10000 AS INTEGER) AS thread_id, CAST(0 AS INTEGER) AS error_code,
  CASE WHEN op_type = 'DDL' THEN 'SYSTEM' END AS time_zone FROM od_log""")
def query_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_and_ddl(spark, sf_dir).select("tx_seq", "op_type", events.query_payload().alias("q")).select(
        "tx_seq", "op_type", "q.db_name", "q.sql", "q.xid", "q.thread_id", "q.error_code", "q.time_zone")


# The logged tables as SQL rows: table, ordinal, column, declared type, type code, metadata bytes, storage bytes, nullable
_COLUMNS_SQL = """
columns(table_, ordinal, column_name, declared, type_code, meta1, meta2, storage_bytes, nullable) AS (VALUES
  ('orders', 1, 'o_orderkey', 'BIGINT', 8, NULL, NULL, 8, false),
  ('orders', 2, 'o_custkey', 'BIGINT', 8, NULL, NULL, 8, true),
  ('orders', 3, 'o_orderstatus', 'CHAR', 254, 254, 4, 1, true),
  ('orders', 4, 'o_totalprice', 'DOUBLE', 5, 8, NULL, 8, true),
  ('orders', 5, 'o_orderdate', 'DATETIME', 12, NULL, NULL, 5, true),
  ('orders', 6, 'o_orderpriority', 'VARCHAR', 15, 15, 0, 1, true),
  ('user_state', 1, 'user_id', 'BIGINT', 8, NULL, NULL, 8, false),
  ('user_state', 2, 'value', 'DOUBLE', 5, 8, NULL, 8, true),
  ('user_state', 3, 'props', 'JSON', 245, 4, NULL, 4, true),
  ('lineitem', 1, 'l_orderkey', 'BIGINT', 8, NULL, NULL, 8, false),
  ('lineitem', 2, 'l_linenumber', 'INT', 3, NULL, NULL, 4, false),
  ('lineitem', 3, 'l_partkey', 'BIGINT', 8, NULL, NULL, 8, true),
  ('lineitem', 4, 'l_suppkey', 'BIGINT', 8, NULL, NULL, 8, true),
  ('lineitem', 5, 'l_quantity', 'DECIMAL', 246, 12, 2, 6, true),
  ('lineitem', 6, 'l_extendedprice', 'DOUBLE', 5, 8, NULL, 8, true),
  ('lineitem', 7, 'l_discount', 'DOUBLE', 5, 8, NULL, 8, true),
  ('lineitem', 8, 'l_tax', 'FLOAT', 4, 4, NULL, 4, true),
  ('lineitem', 9, 'l_returnflag', 'CHAR', 254, 254, 4, 1, true),
  ('lineitem', 10, 'l_linestatus', 'CHAR', 254, 254, 4, 1, true),
  ('lineitem', 11, 'l_shipdate', 'TIMESTAMP', 7, NULL, NULL, 4, true))"""


def _row_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.union_logs(orders_log(spark, sf_dir), events_log(spark, sf_dir), lineitem_log(spark, sf_dir))


@query("table_map", f"""
WITH {_COLUMNS_SQL},
n AS (SELECT 'orders' AS table_, (SELECT count(*) FROM orders) AS n UNION ALL SELECT 'lineitem', (SELECT count(*) FROM lineitem)
  UNION ALL SELECT 'user_state', (SELECT count(*) FROM events WHERE event_type = 'signup'))
SELECT table_, CAST(count(*) AS INTEGER) AS n_columns, string_agg(type_code::VARCHAR, ',' ORDER BY ordinal) AS type_codes,
  string_agg(CASE WHEN nullable THEN '1' ELSE '0' END, ',' ORDER BY ordinal) AS nullable,
  string_agg(concat_ws(',', meta1::VARCHAR, meta2::VARCHAR), ',' ORDER BY ordinal) FILTER (meta1 IS NOT NULL) AS metadata,
  any_value(n.n) AS n_first_inserts
FROM columns JOIN n USING (table_) GROUP BY table_""")
def table_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _row_logs(spark, sf_dir).filter((F.col("op_type") == "I") & (
        (F.col("table_") != "orders") | (F.col("tx_seq") < 2_000_000_000_000)))
    return _counted_maps(log, "n_first_inserts")


@query("table_map_all", f"""
WITH {_COLUMNS_SQL}, {sql.ALL_LOG},
n AS (SELECT table_, count(*) AS n FROM all_log WHERE op_type <> 'DDL' GROUP BY table_)
SELECT table_, CAST(count(*) AS INTEGER) AS n_columns, string_agg(type_code::VARCHAR, ',' ORDER BY ordinal) AS type_codes,
  string_agg(CASE WHEN nullable THEN '1' ELSE '0' END, ',' ORDER BY ordinal) AS nullable,
  string_agg(concat_ws(',', meta1::VARCHAR, meta2::VARCHAR), ',' ORDER BY ordinal) FILTER (meta1 IS NOT NULL) AS metadata,
  any_value(n.n) AS n_maps
FROM columns JOIN n USING (table_) GROUP BY table_""")
def table_map_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted_maps(_row_logs(spark, sf_dir), "n_maps")


def _counted_maps(log: DataFrame, name: str) -> DataFrame:
    maps = log.select("table_", events.table_map_payload().alias("m"))
    return maps.groupBy(
        "table_", F.col("m.n_columns").alias("n_columns"), F.array_join("m.type_codes", ",").alias("type_codes"),
        F.array_join(F.transform("m.nullable", lambda b: b.cast("int").cast("string")), ",").alias("nullable"),
        F.array_join("m.metadata", ",").alias("metadata"),
    ).agg(F.count(F.lit(1)).alias(name))


@query("column_metadata", f"WITH {_COLUMNS_SQL} SELECT table_, ordinal, column_name, type_code, meta1, meta2 FROM columns")
def column_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.table_columns(_row_logs(spark, sf_dir)).select(
        "table_", "ordinal", "column_name", "type_code", "meta1", "meta2")


@query("column_width", f"WITH {_COLUMNS_SQL} SELECT table_, column_name, declared, storage_bytes FROM columns")
def column_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.table_columns(_row_logs(spark, sf_dir)).select("table_", "column_name", "declared", "storage_bytes")


@query("type_lookup", f"""
WITH {_COLUMNS_SQL} SELECT table_, column_name, declared, type_code AS code,
  CASE declared WHEN 'BIGINT' THEN 'LONGLONG' WHEN 'INT' THEN 'LONG' WHEN 'CHAR' THEN 'STRING' WHEN 'DECIMAL' THEN 'NEWDECIMAL'
    ELSE declared END AS code_name FROM columns""")
def type_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.type_lookup(images.table_columns(_row_logs(spark, sf_dir))).select(
        "table_", "column_name", "declared", "code", "code_name")


@query("type_classes", f"""
WITH {_COLUMNS_SQL} SELECT table_, column_name, declared IN ('BIGINT', 'INT') AS is_integer,
  declared IN ('BIGINT', 'INT', 'FLOAT', 'DOUBLE', 'DECIMAL') AS is_numeric, declared IN ('CHAR', 'VARCHAR', 'JSON') AS is_string,
  declared IN ('DATETIME', 'TIMESTAMP') AS is_temporal, declared IN ('DATETIME', 'TIMESTAMP') AS is_with_time,
  declared IN ('DATETIME', 'TIMESTAMP') AS is_with_date, declared IN ('DATETIME', 'TIMESTAMP') AS is_with_date_and_time,
  declared IN ('BIGINT', 'INT', 'FLOAT', 'DOUBLE', 'DECIMAL') AS is_has_sign FROM columns""")
def type_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.table_columns(_row_logs(spark, sf_dir)).select(
        "table_", "column_name", *[types.in_class(F.col("declared"), c).alias(f"is_{c}") for c in types.TYPE_CLASSES])


def faulty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders log with one fault in each of several residue classes of the key."""
    k = F.col("tx_seq") % 1_000_000_000_000 % 97
    stray = F.array_append("new_data", kv("no_such_column", "long", "1"))
    strange = F.transform("fields", lambda f: f.withField("meta.data_type", F.lit("GEOMETRY")))
    doubled = F.concat("new_data", "new_data")
    return orders_log(spark, sf_dir).withColumns({
        "op_type": F.when(k == 1, "X").otherwise(F.col("op_type")),
        "fields": F.when(k == 2, strange).otherwise(F.col("fields")),
        "new_data": F.when(k == 3, stray).when(k == 4, doubled).otherwise(F.col("new_data")),
        "msg_time": F.when(k == 5, F.translate("msg_time", "-", "/")).otherwise(F.col("msg_time")),
        "check_point": F.when(k.isin(5, 6), F.lit("1-2")).otherwise(F.col("check_point")),
    })


@query("quarantine", f"""
WITH {sql.O_LOG}, f AS (SELECT *, o_orderkey % 97 AS k FROM o_log)
SELECT tx_seq, CASE k WHEN 1 THEN 'UNKNOWN_OP' WHEN 2 THEN 'UNKNOWN_TYPE'
  WHEN 3 THEN CASE WHEN op_type = 'I' THEN 'SCHEMA_FIELD_NOT_EXIST,TOO_MANY_VALUES' ELSE 'SCHEMA_FIELD_NOT_EXIST' END
  WHEN 4 THEN 'TOO_MANY_VALUES' WHEN 5 THEN 'BAD_TIME,INVALID_CHECKPOINT' WHEN 6 THEN 'INVALID_CHECKPOINT' END AS reasons
FROM f WHERE k IN (1, 2, 5, 6) OR (k = 3 AND op_type <> 'D') OR (k = 4 AND op_type = 'I')""")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, refused = normalize.split_refused(faulty_orders(spark, sf_dir))
    return refused.select("tx_seq", F.array_join("reasons", ",").alias("reasons"))


@query("accepted", f"""
WITH {sql.O_LOG}, f AS (SELECT *, o_orderkey % 97 AS k FROM o_log)
SELECT op_type, count(*) AS n FROM f
WHERE NOT (k IN (1, 2, 5, 6) OR (k = 3 AND op_type <> 'D') OR (k = 4 AND op_type = 'I')) GROUP BY op_type""")
def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable, _ = normalize.split_refused(faulty_orders(spark, sf_dir))
    return usable.groupBy("op_type").agg(F.count(F.lit(1)).alias("n"))


@query("typed_projection", f"""
WITH {sql.O_LOG}
SELECT tx_seq, CASE WHEN op_type = 'I' THEN o_orderkey END AS o_orderkey,
  CASE WHEN op_type = 'I' THEN o_custkey WHEN phase = 6 THEN o_custkey + 1 END AS o_custkey,
  CASE WHEN op_type = 'I' THEN o_orderstatus WHEN phase = 2 THEN 'F' END AS o_orderstatus,
  CASE WHEN op_type = 'I' THEN o_totalprice END AS o_totalprice, CASE WHEN op_type = 'I' THEN o_orderdate END AS o_orderdate,
  CASE WHEN op_type = 'I' THEN o_orderpriority WHEN phase = 3 THEN '1-URGENT' END AS o_orderpriority
FROM o_log""")
def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.typed_columns(orders_log(spark, sf_dir), ORDER_FIELDS, keep=("tx_seq",))


@query("typed_projection_lineitem", """
SELECT 10000000000000 + l_orderkey AS tx_seq, l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(CAST(l_quantity AS DECIMAL(12,2)) AS VARCHAR) AS l_quantity, l_extendedprice, l_discount,
  CAST(CAST(l_tax AS DECIMAL(10,2)) AS VARCHAR) AS l_tax, l_returnflag, l_linestatus,
  epoch_us(l_shipdate) - 28800000000 AS ship_us FROM lineitem""")
def typed_projection_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = images.typed_columns(lineitem_log(spark, sf_dir), LINEITEM_FIELDS, keep=("tx_seq",))
    return typed.withColumns({
        "l_quantity": F.col("l_quantity").cast("string"),
        "l_tax": F.col("l_tax").cast("decimal(10,2)").cast("string"),
        "ship_us": F.unix_micros("l_shipdate")}).drop("l_shipdate")


@query("typed_projection_events", """
SELECT 20000000000000 + event_id + 1 AS tx_seq, CASE WHEN event_type = 'signup' THEN user_id END AS user_id,
  CASE WHEN event_type NOT IN ('click', 'error') THEN value END AS value,
  CASE WHEN event_type NOT IN ('view', 'error') THEN props END AS props FROM events""")
def typed_projection_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.typed_columns(events_log(spark, sf_dir), EVENT_FIELDS, keep=("tx_seq",))


_IMAGES_SQL = f"""
WITH {sql.O_LOG},
i AS (
  SELECT tx_seq, 'before' AS side, CASE phase WHEN 2 THEN '1,3' WHEN 3 THEN '1,6' ELSE '1' END AS present,
    CASE WHEN phase IN (2, 3) THEN '0,0' ELSE '0' END AS nulls FROM o_log WHERE op_type <> 'I'
  UNION ALL
  SELECT tx_seq, 'after', CASE phase WHEN 2 THEN CASE WHEN o_orderkey % 9 = 0 THEN '3,4' ELSE '3' END
      WHEN 3 THEN '6' WHEN 6 THEN '2' ELSE '1,2,3,4,5,6' END,
    CASE phase WHEN 2 THEN CASE WHEN o_orderkey % 9 = 0 THEN '0,1' ELSE '0' END
      WHEN 3 THEN '0' WHEN 6 THEN '0' ELSE '0,0,0,0,0,0' END FROM o_log WHERE op_type <> 'D'
)"""


@query("row_image", f"{_IMAGES_SQL} SELECT tx_seq, side, present, nulls FROM i")
def row_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.row_images(orders_log(spark, sf_dir)).select(
        "tx_seq", "side", images.present_text(F.col("states")).alias("present"),
        images.null_text(F.col("states")).alias("nulls"))


@query("image_bitmaps", f"""{_IMAGES_SQL}
SELECT tx_seq, side,
  array_to_string([CASE WHEN list_contains(string_split(present, ','), o::VARCHAR) THEN '1' ELSE '0' END
    FOR o IN range(1, list_max([x::INTEGER FOR x IN string_split(present, ',')]) + 1)], '') AS present_bits,
  replace(nulls, ',', '') AS null_bits FROM i""")
def image_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.row_images(orders_log(spark, sf_dir)).select(
        "tx_seq", "side", images.present_bits(F.col("states")).alias("present_bits"),
        images.null_bits(F.col("states")).alias("null_bits"))


@query("changed_columns", f"""
WITH {sql.O_LOG}
SELECT tx_seq, o_orderkey, CASE WHEN phase = 2 AND o_orderstatus <> 'F' THEN 'o_orderstatus'
  WHEN phase = 3 AND o_orderpriority <> '1-URGENT' THEN 'o_orderpriority' ELSE '' END AS changed
FROM o_log WHERE op_type = 'U'""")
def changed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_log(spark, sf_dir).filter(F.col("op_type") == "U").select(
        "tx_seq", images.stated(F.col("keys"), "o_orderkey")["long_val"].alias("o_orderkey"),
        F.array_join(images.changed_names(), ",").alias("changed"))


@query("kv_schema_join", f"""
WITH {sql.O_LOG}, c(column_name, ordinal) AS (VALUES ('o_orderkey', 1), ('o_custkey', 2), ('o_orderstatus', 3),
  ('o_totalprice', 4), ('o_orderdate', 5), ('o_orderpriority', 6))
SELECT tx_seq, column_name, ordinal, CASE WHEN phase = 2 AND column_name = 'o_totalprice' THEN 'NONE'
  WHEN ordinal <= 2 THEN 'LONG' WHEN ordinal = 4 THEN 'DOUBLE' ELSE 'STRING' END AS tag FROM o_log, c
WHERE op_type = 'I' OR (phase = 2 AND (ordinal = 3 OR (ordinal = 4 AND o_orderkey % 9 = 0))) OR (phase = 3 AND ordinal = 6)
  OR (phase = 6 AND ordinal = 2)""")
def kv_schema_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.stated_columns(orders_log(spark, sf_dir))


@query("unknown_columns", f"""
WITH {sql.O_LOG} SELECT tx_seq, 'no_such_column' AS column_name FROM o_log
WHERE o_orderkey % 97 = 3 AND op_type <> 'D'""")
def unknown_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.stated_columns(faulty_orders(spark, sf_dir)).filter(F.col("ordinal").isNull()).select(
        "tx_seq", "column_name")


@query("kv_schema_join_keys", f"""
WITH {sql.O_LOG}, c(column_name, ordinal, tag) AS (VALUES ('o_orderkey', 1, 'LONG'), ('o_orderstatus', 3, 'STRING'),
  ('o_orderpriority', 6, 'STRING'))
SELECT tx_seq, column_name, ordinal, tag FROM o_log, c
WHERE op_type <> 'I' AND (ordinal = 1 OR (phase = 2 AND ordinal = 3) OR (phase = 3 AND ordinal = 6))""")
def kv_schema_join_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.stated_columns(orders_log(spark, sf_dir), "keys")


@query("unknown_columns_keys", f"""
WITH {sql.O_LOG} SELECT tx_seq, 'no_such_column' AS column_name FROM o_log
WHERE o_orderkey % 97 = 3 AND op_type <> 'I'""")
def unknown_columns_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    stray = F.array_append("keys", kv("no_such_column", "long", "1"))
    k = F.col("tx_seq") % 1_000_000_000_000 % 97
    log = orders_log(spark, sf_dir).withColumn("keys", F.when(k == 3, stray).otherwise(F.col("keys")))
    return images.stated_columns(log, "keys").filter(F.col("ordinal").isNull()).select("tx_seq", "column_name")


@query("commit_order", f"""
WITH {sql.OD_LOG} SELECT row_number() OVER (ORDER BY {sql.ORDERED}) AS pos, tx_seq, op_type FROM od_log""")
def commit_order_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = orders_and_ddl(spark, sf_dir).select("scn", "tx_seq", "seq", "lsn", "dn", "op_type")
    return numbered(narrow, commit_order()).select("pos", "tx_seq", "op_type")


@query("priority_order", f"""
WITH {sql.OD_LOG} SELECT row_number() OVER (ORDER BY db_name NULLS FIRST, table_ NULLS FIRST,
    CASE op_type WHEN 'DDL' THEN 0 WHEN 'I' THEN 1 ELSE 2 END, {sql.ORDERED}) AS pos, tx_seq, op_type FROM od_log""")
def priority_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = orders_and_ddl(spark, sf_dir).select("db_name", "table_", "scn", "tx_seq", "seq", "lsn", "dn", "op_type")
    order = [F.col("db_name"), F.col("table_"), source.priority(), *commit_order()]
    return numbered(narrow, order).select("pos", "tx_seq", "op_type")


@query("last_record", f"""
WITH {sql.OD_LOG} SELECT tx_seq, op_type, table_ FROM od_log
ORDER BY scn DESC, tx_seq DESC, seq DESC, lsn DESC, coalesce(dn, -1) DESC LIMIT 1""")
def last_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.last_record(orders_and_ddl(spark, sf_dir)).select("tx_seq", "op_type", "table_")


@query("dedup_records", f"WITH {sql.O_LOG} SELECT tx_seq, op_type, check_point FROM o_log")
def dedup_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = orders_log(spark, sf_dir).select("scn", "tx_seq", "seq", "lsn", "dn", "op_type", "check_point")
    copies = log.filter(F.col("tx_seq") % 1_000_000_000_000 % 5 == 0)
    return source.deduplicate(log.unionAll(copies)).select("tx_seq", "op_type", "check_point")


@query("resume_filter", f"""
WITH {sql.O_LOG} SELECT tx_seq, op_type FROM o_log WHERE scn > 2000000000003000 OR (scn = 2000000000003000 AND seq > 1)""")
def resume_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.after_checkpoint(orders_log(spark, sf_dir), 2_000_000_000_003_000, 2_000_000_000_003, 1).select(
        "tx_seq", "op_type")



@query("resume_between_ties", f"""
WITH {sql.L_LOG}, t AS (
  SELECT scn, tx_seq, seq, min(lsn) AS lsn, min_by(dn, (lsn, dn)) AS dn FROM l_log GROUP BY scn, tx_seq, seq
  ORDER BY count(*) < 2, scn, tx_seq, seq LIMIT 1)
SELECT l.tx_seq, l.seq, l.lsn FROM l_log l, t
WHERE (l.scn, l.tx_seq, l.seq, l.lsn, coalesce(l.dn, -1)) > (t.scn, t.tx_seq, t.seq, t.lsn, coalesce(t.dn, -1))""")
def resume_between_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records after the first of those that tie on (scn, tx_seq, seq), the earliest tie of the log (or its first record)."""
    log = lineitem_log(spark, sf_dir).select("scn", "tx_seq", "seq", "lsn", "dn")
    cut = (log.groupBy("scn", "tx_seq", "seq").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("lsn", "dn")).alias("first"))
           .orderBy(F.col("n") < 2, "scn", "tx_seq", "seq").first())
    if cut is None:
        return log.select("tx_seq", "seq", "lsn")
    return source.after_checkpoint(log, cut["scn"], cut["tx_seq"], cut["seq"], cut["first"]["lsn"], cut["first"]["dn"]).select(
        "tx_seq", "seq", "lsn")


@query("odd_operations", f"""
WITH {sql.O_LOG}, f AS (SELECT o_orderkey % 101 BETWEEN 1 AND 4 AS odd FROM o_log)
SELECT part, count(*) FILTER (part IN ('dml', 'all') OR (part = 'refused' AND odd) OR (part = 'usable' AND NOT odd)) AS n
FROM f, (VALUES ('all'), ('ddl'), ('dml'), ('usable'), ('refused')) AS p(part) GROUP BY part""")
def odd_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with missing, lower-case, empty and unknown operations: each record is definition or not, usable or refused."""
    whole = orders_log(spark, sf_dir)
    key = F.coalesce(stated(F.col("keys"), "o_orderkey")["long_val"], stated(F.col("new_data"), "o_orderkey")["long_val"]) % 101
    keyed = whole.withColumn("_key", key)  # once, not for every case
    key = F.col("_key")
    log = keyed.withColumn("op_type", F.when(key == 1, None).when(key == 2, F.lower("op_type")).when(key == 3, "").when(
        key == 4, "X").otherwise(F.col("op_type"))).drop("_key")
    return normalize.count_parts(log)
