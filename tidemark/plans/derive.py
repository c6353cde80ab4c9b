"""Change logs derived from ordinary tables, so that every operator has a log of any size to run on.

Each log is a projection of its table: the recipes are deterministic and shuffle nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numeric import whole_div
from tidemark.functions.time import commit_text
from tidemark.functions.types import Field
from tidemark.schema import KV, conform

DB = "tpch"
PHASE = 1_000_000_000_000
"""Transactions of phase ``p`` of an order are numbered from ``p * PHASE``."""
LINEITEM_BASE = 10 * PHASE
EVENTS_BASE = 20 * PHASE

ORDER_FIELDS = [
    Field("o_orderkey", "BIGINT", nullable=False),
    Field("o_custkey", "BIGINT"),
    Field("o_orderstatus", "CHAR", 1),
    Field("o_totalprice", "DOUBLE", 20, 2),
    Field("o_orderdate", "DATETIME"),
    Field("o_orderpriority", "VARCHAR", 15),
]
EVENT_FIELDS = [
    Field("user_id", "BIGINT", nullable=False),
    Field("value", "DOUBLE", 20, 2),
    Field("props", "JSON"),
]
LINEITEM_FIELDS = [
    Field("l_orderkey", "BIGINT", nullable=False),
    Field("l_linenumber", "INT", nullable=False),
    Field("l_partkey", "BIGINT"),
    Field("l_suppkey", "BIGINT"),
    Field("l_quantity", "DECIMAL", 12, 2),
    Field("l_extendedprice", "DOUBLE", 20, 2),
    Field("l_discount", "DOUBLE", 20, 2),
    Field("l_tax", "FLOAT", 10, 2),
    Field("l_returnflag", "CHAR", 1),
    Field("l_linestatus", "CHAR", 1),
    Field("l_shipdate", "TIMESTAMP"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Deal out the rows of an input that has fewer splits than the session has cores (a small single file)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def field_list(fields: list[Field]) -> Column:
    """The column descriptions every record of a table carries."""
    described = ", ".join(
        f"named_struct('name', '{f.name}', 'meta', named_struct('data_type', '{f.data_type}', 'length', {f.length}, "
        f"'precision', {f.precision}, 'is_unsigned', {f.is_unsigned}, 'nullable', {f.nullable}, 'csname', 'utf8mb4'))"
        for f in fields)
    return F.expr(f"array({described})")


_EMPTY_ARMS = {"long": "CAST(NULL AS BIGINT)", "double": "CAST(NULL AS DOUBLE)", "string": "CAST(NULL AS STRING)"}


def _kv(name: str, arm: str | None = None, value: str = "") -> str:
    """SQL of a key-value struct whose ``arm`` holds the SQL expression ``value``; explicit NULL without one."""
    arms = {a: (f"CAST({value} AS {a})" if a == arm else empty) for a, empty in _EMPTY_ARMS.items()}
    return (f"named_struct('key', '{name}', 'tag', '{arm.upper() if arm else 'NONE'}', 'long_val', {arms['long']}, "
            f"'double_val', {arms['double']}, 'string_val', {arms['string']})")


def kv(name: str, arm: str | None = None, value: str = "") -> Column:
    return F.expr(_kv(name, arm, value))


def _b64(value: str) -> str:
    """SQL of a base64 payload (short texts, so one line)."""
    return f"base64(CAST({value} AS BINARY))"


def _stamp(ts: str) -> str:
    return _b64(f"date_format({ts}, 'yyyy-MM-dd HH:mm:ss')")


def _image(*values: str) -> str:
    return f"array({', '.join(values)})"


NO_IMAGE = f"CAST(NULL AS ARRAY<{KV.simpleString()}>)"


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _envelope(tx_seq: Column, scn: Column, seq: Column, lsn: Column, dn: Column, last_commit: Column,
              immediate: Column, early: Column) -> list[Column]:
    """Order and time columns; the original commit is 2 s earlier where ``early`` holds."""
    original = immediate - F.when(early, 2_000_000).otherwise(0)
    return [
        F.concat_ws("-", tx_seq.cast("string"), seq.cast("string"), scn.cast("string")).alias("check_point"),
        tx_seq.cast("long").alias("tx_seq"), scn.cast("long").alias("scn"), seq.cast("long").alias("seq"),
        lsn.cast("long").alias("lsn"), dn.cast("short").alias("dn"), last_commit.cast("long").alias("last_commit"),
        commit_text(immediate).alias("msg_time"), commit_text(original).alias("tx_time"),
    ]


def orders_log(spark: SparkSession, sf_dir: str, ranges: int | None = None) -> DataFrame:
    """Inserts, partial updates, deletes, re-inserts and late updates of orders, by phase.

    With ``ranges`` the log comes in that many ranges of commit order. What is shuffled for it are rows of the table: a
    record with its images and field list takes several times as much.
    """
    k = F.col("o_orderkey")
    phases = F.array_compact(F.array(
        F.lit(1), F.when(k % 3 == 0, 2), F.when(k % 6 == 0, 3), F.when(k % 7 == 0, 4), F.when(k % 21 == 0, 5),
        F.when(k % 35 == 0, 6)))
    rows = table(spark, sf_dir, "orders").select("*", F.explode(phases).alias("phase"))
    p = F.col("phase")
    tx = p * F.lit(PHASE) + k
    if ranges:
        rows = rows.repartitionByRange(ranges, tx)  # the commit order follows from it
    op = F.when(p.isin(1, 5), "I").when(p == 4, "D").otherwise("U")
    micros = _micros(F.col("o_orderdate")) + p * F.lit(86_400_000_000) + (k * 7919) % 1_000_000
    key = _kv("o_orderkey", "long", "o_orderkey")
    status = _kv("o_orderstatus", "string", _b64("o_orderstatus"))
    priority = _kv("o_orderpriority", "string", _b64("o_orderpriority"))
    whole = _image(_kv("o_totalprice", "double", "o_totalprice"), key, _kv("o_custkey", "long", "o_custkey"), priority,
                   status, _kv("o_orderdate", "string", _stamp("o_orderdate")))
    closed = _kv("o_orderstatus", "string", _b64("'F'"))
    keys = F.expr(f"""CASE phase WHEN 2 THEN {_image(key, status)} WHEN 3 THEN {_image(key, priority)}
        WHEN 4 THEN {_image(key)} WHEN 6 THEN {_image(key)} ELSE {NO_IMAGE} END""")
    new = F.expr(f"""CASE WHEN phase IN (1, 5) THEN {whole}
        WHEN phase = 2 AND o_orderkey % 9 = 0 THEN {_image(closed, _kv("o_totalprice"))}
        WHEN phase = 2 THEN {_image(closed)}
        WHEN phase = 3 THEN {_image(_kv("o_orderpriority", "string", _b64("'1-URGENT'")))}
        WHEN phase = 6 THEN {_image(_kv("o_custkey", "long", "o_custkey + 1"))} ELSE {NO_IMAGE} END""")
    return conform(rows.select(
        *_envelope(tx, tx * 1000, F.lit(1), tx, k % 4, tx - 1, micros, k % 2 == 0),
        F.lit(DB).alias("db_name"), F.lit("orders").alias("table_"), op.alias("op_type"),
        field_list(ORDER_FIELDS).alias("fields"), keys.alias("keys"), new.alias("new_data")))


def lineitem_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One insert per line; the lines of an order are one transaction."""
    rows = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    tx = F.lit(LINEITEM_BASE) + k
    lsn = F.col("l_partkey") * 10_000_000 + F.col("l_suppkey") * 100 + F.col("l_quantity").cast("long")
    new = F.expr(_image(
        _kv("l_shipdate", "string", _stamp("l_shipdate")),
        *[_kv(c, "long", c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
        _kv("l_quantity", "string", "CAST(l_quantity AS DECIMAL(12,2))"),
        *[_kv(c, "double", c) for c in ("l_extendedprice", "l_discount", "l_tax")],
        *[_kv(c, "string", _b64(c)) for c in ("l_returnflag", "l_linestatus")]))
    return conform(rows.select(
        *_envelope(tx, tx * 1000, F.col("l_linenumber"), lsn, F.col("l_suppkey") % 4, tx - 1,
                   _micros(F.col("l_shipdate")), k % 2 == 0),
        F.lit(DB).alias("db_name"), F.lit("lineitem").alias("table_"), F.lit("I").alias("op_type"),
        field_list(LINEITEM_FIELDS).alias("fields"), F.expr(NO_IMAGE).alias("keys"), new.alias("new_data")))


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of users: ``signup`` inserts, ``error`` deletes, the rest update one or both columns."""
    rows = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    tx = F.lit(EVENTS_BASE) + F.col("event_id") + 1
    user = _kv("user_id", "long", "user_id")
    value = _kv("value", "double", "value")
    props = _kv("props", "string", _b64("props"))
    op = F.when(kind == "signup", "I").when(kind == "error", "D").otherwise("U")
    keys = F.expr(f"CASE WHEN event_type = 'signup' THEN {NO_IMAGE} ELSE {_image(user)} END")
    new = F.expr(f"""CASE event_type WHEN 'signup' THEN {_image(props, user, value)} WHEN 'view' THEN {_image(value)}
        WHEN 'click' THEN {_image(props)} WHEN 'error' THEN {NO_IMAGE} ELSE {_image(props, value)} END""")
    return conform(rows.select(
        *_envelope(tx, tx * 1000, F.lit(1), tx, F.col("user_id") % 4,
                   F.lit(EVENTS_BASE) + F.col("event_id") - F.col("event_id") % 4, _micros(F.col("ts")),
                   F.col("event_id") % 2 == 0),
        F.lit(DB).alias("db_name"), F.lit("user_state").alias("table_"), op.alias("op_type"),
        field_list(EVENT_FIELDS).alias("fields"),
        keys.alias("keys"), new.alias("new_data")))


def ddl_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions: a shop per five customers with a table per customer, and a new version of the orders table
    per customer, spread over the phases of the orders log."""
    k = F.col("c_custkey")
    steps = F.array_compact(F.array(
        F.when(k % 5 == 0, 1), F.lit(2), F.when(k % 3 == 0, 3), F.when(k % 10 == 0, 4), F.lit(5)))
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", F.explode(steps).alias("step"))
    s = F.col("step")
    shop = F.concat(F.lit("shop_"), whole_div(k, 5).cast("string"))
    own = F.concat(F.lit("cust_"), k.cast("string"))
    sql = (
        F.when(s == 1, F.concat(F.lit("create database "), shop))
        .when(s == 2, F.concat(F.lit("create table "), own, F.lit(" (id int primary key, seg enum('"), F.col("c_mktsegment"),
                               F.lit("','bb','cc'), flags set('dd','ee','ff'))")))
        .when(s == 3, F.concat(F.lit("drop table "), own))
        .when(s == 4, F.concat(F.lit("drop database "), shop))
        .otherwise(F.concat(F.lit("alter table orders comment 'v"), k.cast("string"), F.lit("'"))))
    phase = F.when(s == 5, k % 6 + 1).otherwise(s)
    tx = phase * F.lit(PHASE) + k * 10
    micros = F.lit(1_722_493_959_000_068) + tx % F.lit(PHASE) * 1000
    kind = F.when(s.isin(1, 2), "CREATE TABLE").when(s == 3, "DROP TABLE").when(s == 5, "ALTER TABLE")
    return conform(rows.select(
        *_envelope(tx, tx * 1000, F.when(s == 5, 2).otherwise(0), tx, F.lit(None), tx - 1, micros, k % 2 == 0),
        F.when(s.isin(2, 3), shop).when(s == 5, DB).alias("db_name"),
        F.when(s.isin(2, 3), own).when(s == 5, "orders").alias("table_"),
        F.lit("DDL").alias("op_type"), sql.alias("ddl_sql"), kind.alias("ddl_type")))
