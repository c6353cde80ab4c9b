"""Catalogue entries of the column functions. Input text is made from table columns, then parsed back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import ids, numeric, text, time, types
from tidemark.functions.size import length_of_length
from tidemark.plans import logs_sql as sql
from tidemark.plans.derive import ddl_log, orders_log, table
from tidemark.plans.registry import query


def _case(selector, *branches):
    """``branches[i]`` where ``selector == i``."""
    return reduce(lambda acc, b: acc.when(selector == b[0], b[1]), enumerate(branches[1:], 1),
                  F.when(selector == 0, branches[0]))


@query("commit_micros", f"""
WITH {sql.O_LOG}
SELECT tx_seq, immediate_us, original_us,
  strftime(make_timestamp(immediate_us + 28800000000), '%Y-%m-%d %H:%M:%S.%f') AS msg_time,
  immediate_us - immediate_us % 1000 AS millis_us, CAST(NULL AS BIGINT) AS bad_us
FROM o_log""")
def commit_micros(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = orders_log(spark, sf_dir)
    return log.select(
        "tx_seq", time.commit_micros(F.col("msg_time")).alias("immediate_us"),
        time.commit_micros(F.col("tx_time")).alias("original_us"), "msg_time",
        time.commit_micros(F.substring("msg_time", 1, 23)).alias("millis_us"),
        time.commit_micros(F.translate("msg_time", "-", "/")).alias("bad_us"))


@query("checkpoint_parse", f"""
WITH {sql.O_LOG},
t AS (
  SELECT tx_seq AS id, scn, CASE o_orderkey % 6 WHEN 0 THEN check_point WHEN 1 THEN tx_seq::VARCHAR || '-1'
    WHEN 2 THEN check_point || '-4' WHEN 3 THEN tx_seq::VARCHAR || '-1-' WHEN 4 THEN 'a' || check_point
    ELSE tx_seq::VARCHAR || '-4294967299-' || scn::VARCHAR END AS txt, o_orderkey % 6 AS kind
  FROM o_log
)
SELECT id, txt, kind IN (0, 3, 5) AS valid,
  CASE WHEN kind IN (0, 3, 5) THEN id::VARCHAR END AS parsed_tx,
  CASE WHEN kind IN (0, 3) THEN CAST(1 AS BIGINT) WHEN kind = 5 THEN 3 END AS parsed_seq,
  CASE WHEN kind IN (0, 5) THEN scn::VARCHAR WHEN kind = 3 THEN '0' END AS parsed_scn,
  CASE WHEN kind = 0 THEN txt WHEN kind = 3 THEN txt || '0' WHEN kind = 5 THEN id::VARCHAR || '-3-' || scn::VARCHAR END AS formatted
FROM t""")
def checkpoint_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx, point = F.col("tx_seq").cast("string"), F.col("check_point")
    txt = _case(
        F.col("tx_seq") % 1_000_000_000_000 % 6, point, F.concat(tx, F.lit("-1")), F.concat(point, F.lit("-4")),
        F.concat(tx, F.lit("-1-")), F.concat(F.lit("a"), point),
        F.concat(tx, F.lit("-4294967299-"), F.col("scn").cast("string")))
    parsed = orders_log(spark, sf_dir).select(F.col("tx_seq").alias("id"), txt.alias("txt")).withColumn(
        "p", ids.parse_checkpoint(F.col("txt")))
    return parsed.select(
        "id", "txt", F.col("p").isNotNull().alias("valid"), F.col("p.tx_seq").cast("string").alias("parsed_tx"),
        F.col("p.seq").alias("parsed_seq"), F.col("p.scn").cast("string").alias("parsed_scn"),
        F.when(F.col("p").isNotNull(), ids.format_checkpoint(F.col("p.tx_seq"), F.col("p.seq"), F.col("p.scn"))).alias("formatted"))


@query("decode_text", """
SELECT doc_id, md5(text) AS digest, CAST(strlen(text) AS INTEGER) AS n_bytes,
  CAST((strlen(text) + 2) // 3 * 4 + ((strlen(text) + 2) // 3 * 4 - 1) // 76 AS INTEGER) AS n_encoded,
  CAST(NULL AS VARCHAR) AS damaged
FROM documents""")
def decode_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", text.encode_text(F.col("text"), 76).alias("payload"))
    decoded = docs.withColumn("decoded", text.decode_text(F.col("payload")))
    return decoded.select(
        "doc_id", F.md5(F.col("decoded").cast("binary")).alias("digest"), F.octet_length("decoded").alias("n_bytes"),
        F.length("payload").alias("n_encoded"), text.decode_text(F.concat(F.lit("*"), F.col("payload"))).alias("damaged"))


@query("fixed_width_number", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  format('{:.2f}', l_extendedprice) AS free,
  CASE WHEN length(format('{:.2f}', l_extendedprice)) <= 7 THEN format('{:.2f}', l_extendedprice) END AS narrow,
  CAST(format('{:.1f}', l_extendedprice) AS DOUBLE) AS one_digit,
  format('{:.3f}', l_extendedprice * (1 - l_discount) / 7) AS many_digits
FROM lineitem""")
def fixed_width_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        numeric.fixed_width_text(price, 0, 2).alias("free"), numeric.fixed_width_text(price, 7, 2).alias("narrow"),
        numeric.fixed_width_number(price, 20, 1).alias("one_digit"),
        numeric.fixed_width_text(price * (1 - F.col("l_discount")) / 7, 0, 3).alias("many_digits"))


@query("decimal_values", """
WITH t AS (
  SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || ((l_partkey % 100 + 100)::VARCHAR)[2:3] AS txt FROM lineitem
)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, txt,
  CAST(CAST(txt AS DECIMAL(12,3)) AS VARCHAR) AS half_up,
  CAST(CAST(trunc(CAST(txt AS DECIMAL(18,4)) * 1000) AS BIGINT) AS VARCHAR) AS cut_thousandths,
  CAST(TRY_CAST(txt AS DECIMAL(6,2)) AS VARCHAR) AS narrow,
  CAST(NULL AS VARCHAR) AS bad,
  CAST(6 AS INTEGER) AS bytes_12_3, CAST(length(CAST(floor(CAST(txt AS DECIMAL(18,4))) AS BIGINT)::VARCHAR) AS INTEGER) AS whole_digits
FROM t""")
def decimal_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    txt = F.concat(numeric.fixed_width_text(F.col("l_extendedprice"), 0, 2),
                   F.substring((F.col("l_partkey") % 100 + 100).cast("string"), 2, 2))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", txt.alias("txt"))
    t = F.col("txt")
    return rows.select(
        "*", numeric.decimal_value(t, 12, 3).cast("string").alias("half_up"),
        (numeric.decimal_value(t, 12, 3, "trunc") * 1000).cast("long").cast("string").alias("cut_thousandths"),
        numeric.decimal_value(t, 6, 2).cast("string").alias("narrow"),
        numeric.decimal_value(F.concat(F.lit("x"), t), 12, 3).cast("string").alias("bad"),
        numeric.decimal_bytes(F.lit(12), F.lit(3)).alias("bytes_12_3"),
        numeric.digit_count(t.cast("decimal(18,4)").cast("long")).alias("whole_digits"))


@query("narrow_ints", """
WITH t AS (SELECT *, (l_partkey - 1000) * 1000003 + l_suppkey AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  xor(v & 255, 128) - 128 AS as8, xor(v & 65535, 32768) - 32768 AS as16,
  xor(v & 16777215, 8388608) - 8388608 AS as24, xor(v & 4294967295, 2147483648) - 2147483648 AS as32, v AS as64
FROM t""")
def narrow_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = (F.col("l_partkey") - 1000) * 1_000_003 + F.col("l_suppkey")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        *[numeric.narrow_int(v, bits).alias(f"as{bits}") for bits in (8, 16, 24, 32, 64)])


@query("unsigned_values", """
WITH t AS (SELECT *, (l_partkey - 1000) * 1000003 - l_suppkey AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, v & 255 AS as8, v & 65535 AS as16, v & 16777215 AS as24,
  v & 4294967295 AS as32,
  CASE WHEN v < 0 THEN (CAST(v AS HUGEINT) + 18446744073709551616)::VARCHAR ELSE v::VARCHAR END AS as64
FROM t""")
def unsigned_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = (F.col("l_partkey") - 1000) * 1_000_003 - F.col("l_suppkey")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        *[numeric.unsigned_int(v, bits).alias(f"as{bits}") for bits in (8, 16, 24, 32)],
        numeric.unsigned_int(v, 64).cast("string").alias("as64"))


@query("year_code", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y,
  CAST(CASE WHEN year(o_orderdate) >= 2000 THEN year(o_orderdate) - 2000 ELSE year(o_orderdate) - 1900 END AS INTEGER) AS code
FROM orders""")
def year_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("y")).withColumn(
        "code", time.year_code(F.col("y")))


@query("parse_time", """
WITH t AS (
  SELECT event_id, event_id % 8 AS kind, CAST(hour(ts) AS BIGINT) AS h, CAST(minute(ts) AS BIGINT) AS m,
    epoch_us(ts) % 60000000 // 1000000 AS s, epoch_us(ts) % 1000000 AS f, user_id % 30 AS d FROM events
), x AS (
  SELECT *, CASE kind
    WHEN 0 THEN printf('%02d:%02d:%02d.%06d', h, m, s, f)
    WHEN 1 THEN printf('-%02d:%02d', h, m)
    WHEN 2 THEN printf('%d %02d:%02d:%02d', d, h, m, s)
    WHEN 3 THEN printf('%d%02d%02d', h + 100, m, s)
    WHEN 4 THEN printf('%d', m * 100 + s)
    WHEN 5 THEN printf(' -%d %02d:%02d.%02d', d, h, m, f // 10000)
    WHEN 6 THEN printf('%02d:99:%02d', h, s)
    ELSE 'noon' END AS txt FROM t
)
SELECT event_id, txt, CASE kind
    WHEN 0 THEN ((h * 60 + m) * 60 + s) * 1000000 + f
    WHEN 1 THEN -(h * 60 + m) * 60000000
    WHEN 2 THEN (((d * 24 + h) * 60 + m) * 60 + s) * 1000000
    WHEN 3 THEN (((h + 100) * 60 + m) * 60 + s) * 1000000
    WHEN 4 THEN (m * 60 + s) * 1000000
    WHEN 5 THEN -(((d * 24 + h) * 60 + m) * 60000000 + f // 10000 * 10000) END AS micros,
  CASE WHEN kind = 0 THEN ((h * 4096 + m * 64 + s) * 16777216) + f WHEN kind = 1 THEN -(h * 4096 + m * 64) * 16777216 END AS packed
FROM x""")
def parse_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    parts = table(spark, sf_dir, "events").select(
        "event_id", F.hour("ts").alias("h"), F.minute("ts").alias("m"), F.second("ts").alias("s"),
        (micros % 1_000_000).alias("f"), (F.col("user_id") % 30).alias("d"))
    h, m, s, f, d = (F.col(c) for c in "hmsfd")
    kind = F.col("event_id") % 8
    txt = _case(
        kind, F.format_string("%02d:%02d:%02d.%06d", h, m, s, f), F.format_string("-%02d:%02d", h, m),
        F.format_string("%d %02d:%02d:%02d", d, h, m, s), F.format_string("%d%02d%02d", h + 100, m, s),
        (m * 100 + s).cast("string"), F.format_string(" -%d %02d:%02d.%02d", d, h, m, numeric.whole_div(f, 10_000)),
        F.format_string("%02d:99:%02d", h, s), F.lit("noon"))
    parsed = parts.select("event_id", txt.alias("txt")).withColumn("micros", time.time_micros(F.col("txt")))
    return parsed.withColumn("packed", F.when(kind <= 1, time.pack_time(F.col("micros"))))


@query("parse_datetime", """
WITH x AS (
  SELECT event_id, ts, event_id % 10 AS kind, CASE event_id % 10
    WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
    WHEN 1 THEN strftime(ts, '%Y%m%d%H%M%S')
    WHEN 2 THEN strftime(ts, '%Y%m%dT%H%M%S')
    WHEN 3 THEN strftime(ts, '%y-%m-%d')
    WHEN 4 THEN strftime(ts, '%y%m%d')
    WHEN 5 THEN strftime(ts, '  %Y/%m/%d %H.%M.%S')
    WHEN 6 THEN strftime(ts, '%y%m%d%H%M%S')
    WHEN 7 THEN strftime(ts, '%Y-13-%d')
    WHEN 8 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.') || printf('%03d', epoch_us(ts) % 1000000 // 1000)
    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S+08:00') END AS txt FROM events
)
SELECT event_id, txt, CASE
    WHEN kind = 0 THEN epoch_us(ts)
    WHEN kind IN (1, 2, 5, 6, 9) THEN epoch_us(date_trunc('second', ts))
    WHEN kind IN (3, 4) THEN epoch_us(date_trunc('day', ts))
    WHEN kind = 8 THEN epoch_us(date_trunc('millisecond', ts)) END AS micros,
  CASE WHEN kind = 9 THEN CAST(28800 AS BIGINT) END AS zone
FROM x""")
def parse_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    def shown(fmt):
        return F.date_format("ts", fmt)

    txt = _case(
        F.col("event_id") % 10, shown("yyyy-MM-dd HH:mm:ss.SSSSSS"), shown("yyyyMMddHHmmss"), shown("yyyyMMdd'T'HHmmss"),
        shown("yy-MM-dd"), shown("yyMMdd"), F.concat(F.lit("  "), shown("yyyy/MM/dd HH.mm.ss")), shown("yyMMddHHmmss"),
        shown("yyyy-'13'-dd"), shown("yyyy-MM-dd'T'HH:mm:ss.SSS"), F.concat(shown("yyyy-MM-dd HH:mm:ss"), F.lit("+08:00")))
    return table(spark, sf_dir, "events").select("event_id", txt.alias("txt")).select(
        "event_id", "txt", time.ntz_micros(time.parse_datetime(F.col("txt"))).alias("micros"),
        time.trailing_zone(F.col("txt")).alias("zone"))


@query("parse_tz_offset", """
WITH t AS (SELECT o_orderkey, o_orderkey % 17 AS h, o_orderkey // 17 % 70 AS m, o_orderkey % 3 AS kind FROM orders),
x AS (SELECT *, printf('%s%02d:%02d', CASE kind WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE '' END, h, m) AS txt FROM t)
SELECT o_orderkey, txt, CASE WHEN kind < 2 AND m < 60 AND h * 60 + m <= 840 AND NOT (kind = 1 AND h = 0 AND m = 0)
  THEN (h * 3600 + m * 60) * CASE kind WHEN 0 THEN 1 ELSE -1 END END AS seconds FROM x""")
def parse_tz_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    sign = _case(k % 3, F.lit("+"), F.lit("-"), F.lit(""))
    txt = F.format_string("%s%02d:%02d", sign, k % 17, numeric.whole_div(k, 17) % 70)
    return table(spark, sf_dir, "orders").select("o_orderkey", txt.alias("txt")).withColumn(
        "seconds", time.zone_offset_seconds(F.col("txt")))


@query("local_to_epoch", """
SELECT event_id, epoch_us(ts) // 1000000 - 28800 AS at_east, epoch_us(ts) // 1000000 AS at_utc,
  CASE WHEN epoch_us(ts - to_years(CAST(event_id % 100 AS INTEGER))) // 1000000 - 28800 BETWEEN 0 AND 32536771199
    THEN epoch_us(ts - to_years(CAST(event_id % 100 AS INTEGER))) // 1000000 - 28800 ELSE 0 END AS earlier
FROM events""")
def local_to_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    earlier = ts - F.make_ym_interval((F.col("event_id") % 100).cast("int"), F.lit(0))
    return table(spark, sf_dir, "events").select(
        "event_id", time.local_epoch(ts, "+08:00").alias("at_east"), time.local_epoch(ts, "UTC").alias("at_utc"),
        time.local_epoch(earlier, "+08:00").alias("earlier"))


@query("day_number", """
SELECT o_orderkey, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) + 719528 AS INTEGER) AS day_no FROM orders""")
def day_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", time.day_number(F.col("o_orderdate")).alias("day_no"))


@query("packed_datetime", """
SELECT event_id,
  ((((year(ts) * 13 + month(ts)) * 32 + day(ts)) * 131072 + hour(ts) * 4096 + minute(ts) * 64 + epoch_us(ts) % 60000000 // 1000000)
    * 16777216) + epoch_us(ts) % 1000000 AS packed
FROM events""")
def packed_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", time.pack_datetime(F.col("ts")).alias("packed"))


@query("fraction_digits", """
SELECT event_id, CAST((event_id % 7 + 1) // 2 AS INTEGER) AS extra_bytes,
  epoch_us(ts) - epoch_us(ts) % CAST(power(10, 6 - event_id % 7) AS BIGINT) AS cut_us
FROM events""")
def fraction_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = (F.col("event_id") % 7).cast("int")
    return table(spark, sf_dir, "events").select(
        "event_id", time.fraction_bytes(digits).alias("extra_bytes"),
        time.truncate_fraction(time.ntz_micros(F.col("ts")), digits).alias("cut_us"))


_UUID_SQL = """
WITH h AS (SELECT event_id, md5(user_id::VARCHAR) AS x FROM events),
u AS (SELECT event_id, x, x[1:8] || '-' || x[9:12] || '-' || x[13:16] || '-' || x[17:20] || '-' || x[21:32] AS dashed FROM h)"""


def _dashed(hex32):
    return F.concat_ws("-", *[F.substring(hex32, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


@query("normalize_uuid", f"""{_UUID_SQL}
SELECT event_id, CASE event_id % 5 WHEN 0 THEN dashed WHEN 1 THEN upper(x) WHEN 2 THEN '{{' || upper(dashed) || '}}'
    WHEN 3 THEN 'g' || dashed[2:36] ELSE x || '-' END AS txt,
  CASE WHEN event_id % 5 < 3 THEN dashed END AS uuid FROM u""")
def normalize_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.md5(F.col("user_id").cast("string").cast("binary"))
    dashed = _dashed(x)
    txt = _case(
        F.col("event_id") % 5, dashed, F.upper(x), F.concat(F.lit("{"), F.upper(dashed), F.lit("}")),
        F.concat(F.lit("g"), F.substring(dashed, 2, 35)), F.concat(x, F.lit("-")))
    return table(spark, sf_dir, "events").select("event_id", txt.alias("txt")).withColumn(
        "uuid", ids.normalize_uuid(F.col("txt")))


@query("parse_gtid", f"""{_UUID_SQL}
SELECT event_id, CASE event_id % 6 WHEN 0 THEN dashed || ':' || event_id::VARCHAR WHEN 1 THEN ' ' || upper(dashed) || ' : ' || event_id::VARCHAR || ' '
    WHEN 2 THEN dashed || ':0x1F' WHEN 3 THEN dashed || ':9223372036854775807' WHEN 4 THEN dashed ELSE x || ':1' END AS txt,
  CASE WHEN event_id % 6 < 2 AND event_id > 0 THEN dashed END AS sid,
  CASE WHEN event_id % 6 < 2 AND event_id > 0 THEN event_id END AS gno,
  CASE WHEN event_id % 6 < 2 AND event_id > 0 THEN dashed || ':' || event_id::VARCHAR END AS formatted,
  CASE event_id % 6 WHEN 0 THEN 'AUTOMATIC' WHEN 1 THEN 'ASSIGNED' WHEN 2 THEN 'ANONYMOUS' WHEN 3 THEN 'UNDEFINED'
    WHEN 4 THEN 'NOT_YET_DETERMINED' ELSE 'PRE_GENERATE_GTID' END AS kind
FROM u""")
def parse_gtid(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.md5(F.col("user_id").cast("string").cast("binary"))
    dashed, n = _dashed(x), F.col("event_id").cast("string")
    txt = _case(
        F.col("event_id") % 6, F.concat(dashed, F.lit(":"), n),
        F.concat(F.lit(" "), F.upper(dashed), F.lit(" : "), n, F.lit(" ")), F.concat(dashed, F.lit(":0x1F")),
        F.concat(dashed, F.lit(":9223372036854775807")), dashed, F.concat(x, F.lit(":1")))
    parsed = table(spark, sf_dir, "events").select("event_id", txt.alias("txt")).withColumn("g", ids.parse_gtid(F.col("txt")))
    return parsed.select(
        "event_id", "txt", F.col("g.sid").alias("sid"), F.col("g.gno").alias("gno"),
        F.when(F.col("g").isNotNull(), ids.format_gtid(F.col("g.sid"), F.col("g.gno"))).alias("formatted"),
        ids.gtid_kind((F.col("event_id") % 6).cast("int")).alias("kind"))


@query("enum_set_labels", f"""
WITH {sql.D_LOG}
SELECT tx_seq, CASE k % 5 WHEN 0 THEN '' WHEN 1 THEN (SELECT c_mktsegment FROM customer WHERE c_custkey = k) WHEN 2 THEN 'bb' WHEN 3 THEN 'cc' END AS label,
  CASE k % 8 WHEN 0 THEN '' WHEN 1 THEN 'dd' WHEN 2 THEN 'ee' WHEN 3 THEN 'dd,ee' WHEN 4 THEN 'ff' WHEN 5 THEN 'dd,ff'
    WHEN 6 THEN 'ee,ff' ELSE 'dd,ee,ff' END AS flags
FROM d_log WHERE step = 2""")
def enum_set_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = ddl_log(spark, sf_dir).filter(F.col("ddl_sql").startswith("create table"))
    k = numeric.whole_div(F.col("tx_seq") % 1_000_000_000_000, 10)
    return made.select(
        "tx_seq", numeric.enum_label(numeric.declared_labels(F.col("ddl_sql"), "enum"), k % 5).alias("label"),
        F.array_join(numeric.set_labels(numeric.declared_labels(F.col("ddl_sql"), "set"), k % 8), ",").alias("flags"))


@query("bit_values", """
SELECT o_orderkey, right(CAST(CAST(o_custkey * 37 AS INTEGER) AS BIT)::VARCHAR, 23) AS bits, CAST(3 AS INTEGER) AS n_bytes FROM orders""")
def bit_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", numeric.bit_text(F.col("o_custkey") * 37, 23).alias("bits"),
        types.storage_bytes(F.lit("BIT"), F.lit(23), F.lit(0)).alias("n_bytes"))


@query("json_values", """
SELECT event_id, props AS payload, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS damaged FROM events""")
def json_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = table(spark, sf_dir, "events").select("event_id", text.encode_text(F.col("props")).alias("e"), "props")
    payload = text.json_text(F.col("e"))
    return encoded.select(
        "event_id", payload.alias("payload"), F.get_json_object(payload, "$.k").cast("int").alias("k"),
        text.json_text(text.encode_text(F.substr("props", F.lit(2)))).alias("damaged"))


@query("blob_class", """
SELECT doc_id, CASE WHEN strlen(text) < 256 THEN 'TINYBLOB' WHEN strlen(text) < 65536 THEN 'BLOB'
    WHEN strlen(text) < 16777216 THEN 'MEDIUMBLOB' ELSE 'LONGBLOB' END AS blob_type,
  CAST(CASE WHEN strlen(text) < 251 THEN 1 WHEN strlen(text) < 65536 THEN 3 WHEN strlen(text) < 16777216 THEN 4 ELSE 9 END AS INTEGER) AS length_bytes
FROM documents""")
def blob_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.octet_length("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", types.blob_type_for(n).alias("blob_type"), length_of_length(n).alias("length_bytes"))
