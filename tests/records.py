"""A 27-column record like those of a table with every common type, and small helpers to build records."""

import base64

ENVELOPE = {
    "check_point": "38-1-54349495054337", "db_name": "t1", "table_": "t1", "op_type": "I", "ddl_sql": None, "ddl_type": None,
    "last_commit": 33, "lsn": 279792, "scn": 54349495054337, "seq": 1, "tx_seq": 38,
    "msg_time": "2024-08-01 14:32:41.000145", "tx_time": "2024-08-01 14:32:39.000238", "dn": 0, "old_data": None,
}


def meta(data_type, length=0, precision=0, unsigned=False, nullable=True):
    return {"data_type": data_type, "length": length, "precision": precision, "is_unsigned": unsigned, "nullable": nullable,
            "csname": "utf8mb4"}


def kv(key, value=None):
    tag = {type(None): "NONE", int: "LONG", float: "DOUBLE", str: "STRING"}[type(value)]
    return {"key": key, "tag": tag, "long_val": value if tag == "LONG" else None,
            "double_val": value if tag == "DOUBLE" else None, "string_val": value if tag == "STRING" else None}


def b64(value):
    return base64.b64encode(value.encode() if isinstance(value, str) else value).decode()


COLUMNS = [
    ("a1", meta("INT", nullable=False)), ("a2", meta("CHAR", 20)), ("a3", meta("BIT", 23)), ("a4", meta("SMALLINT")),
    ("a5", meta("SMALLINT", unsigned=True)), ("a6", meta("MEDIUMINT")), ("a7", meta("MEDIUMINT", unsigned=True)),
    ("a8", meta("INT", unsigned=True)), ("a9", meta("BIGINT")), ("a10", meta("BIGINT", unsigned=True)),
    ("a11", meta("FLOAT", 10, 5)), ("a12", meta("FLOAT", 10, 5, True)), ("a13", meta("DOUBLE", 20, 10)),
    ("a14", meta("DOUBLE", 20, 10, True)), ("a15", meta("DECIMAL", 10, 5)), ("a16", meta("DECIMAL", 10, 5, True)),
    ("a17", meta("YEAR", 4)), ("a18", meta("ENUM", 3)), ("a19", meta("SET", 3)), ("a20", meta("TINYTEXT")),
    ("a21", meta("TEXT")), ("a22", meta("MEDIUMTEXT")), ("a23", meta("LONGTEXT")), ("a24", meta("TINYBLOB")),
    ("a25", meta("BLOB")), ("a26", meta("MEDIUMBLOB")), ("a27", meta("LONGBLOB")),
]
FIELDS = [{"name": n, "meta": m} for n, m in COLUMNS]

# not in column order
NEW_DATA = [
    kv("a11", 3.402820110321045), kv("a10", -1), kv("a9", -9_000_000_000), kv("a12"), kv("a15", "3.40282"),
    kv("a1", 4), kv("a3", 5), kv("a4", -32768), kv("a5", 65535), kv("a6", -8388608), kv("a7", 16777215), kv("a8", 4294967295),
    kv("a13", 1.5), kv("a14", 2.25), kv("a16", "0.05000"), kv("a17", 2024), kv("a18", 2), kv("a19"), kv("a20"),
    kv("a2", b64("a")), kv("a21", b64("text")), kv("a22", b64("medium")), kv("a23", b64("long text")),
    kv("a24", b64(b"\x00\x01")), kv("a25", b64(b"\xff")), kv("a26", b64(b"mm")), kv("a27", b64(b"l")),
]
INSERT = {**ENVELOPE, "fields": FIELDS, "keys": None, "new_data": NEW_DATA}


def ddl(check_point, db, table, sql, kind, tx_seq, scn, msg, tx, last_commit, lsn=0):
    return {**ENVELOPE, "check_point": check_point, "db_name": db, "table_": table, "op_type": "DDL", "ddl_sql": sql,
            "ddl_type": kind, "tx_seq": tx_seq, "scn": scn, "msg_time": msg, "tx_time": tx, "last_commit": last_commit,
            "lsn": lsn, "dn": None, "fields": None, "keys": None, "new_data": None}


DAY = "2024-08-01 14:32:"
DDL_RECORDS = [
    ddl("31-1-54348795023361", None, None, "create database t1", "CREATE TABLE", 31, 54348795023361, DAY + "41.000054",
        DAY + "39.000068", 30),
    ddl("33-1-54349172944897", "t1", "temp", "create table temp (a1 int)", "CREATE TABLE", 33, 54349172944897,
        DAY + "41.000117", DAY + "39.000160", 32, 279711),
    ddl("43-1-54350345428993", "t1", "temp", "drop table t1", "DROP TABLE", 43, 54350345428993, DAY + "41.000156",
        DAY + "39.000446", 42, 280191),
    ddl("46-1-54350647873537", None, None, "drop database t1", None, 46, 54350647873537, DAY + "41.000157",
        DAY + "39.000520", 45, 281581),
]
