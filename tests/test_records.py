import decimal
import random

import pytest
from pyspark.sql import functions as F
from records import DDL_RECORDS, FIELDS, INSERT, b64, kv, meta

from tidemark.functions.types import Field
from tidemark.operators import events, images, normalize
from tidemark.plans import derive
from tidemark.plans.catalogue import QUERIES
from tidemark.schema import CHANGE_SCHEMA
from tidemark.sources.change_log import read_change_log, route, write_change_log


def frame(spark, *records):
    return spark.createDataFrame(list(records), CHANGE_SCHEMA)


def test_typed_values_of_a_27_column_record(spark):
    log = frame(spark, INSERT)
    fields = images.table_fields(log, "t1", "t1")
    assert len(fields) == 27 and fields[0] == Field("a1", "INT", 0, 0, False, False)
    row = images.typed_columns(log, fields).first().asDict()
    assert row["a1"] == 4 and row["a2"] == "a" and row["a3"] == 5
    assert row["a4"] == -32768 and row["a5"] == 65535 and row["a6"] == -8388608 and row["a7"] == 16777215
    assert row["a8"] == 4294967295 and row["a9"] == -9_000_000_000
    assert row["a10"] == decimal.Decimal(18446744073709551615)
    assert abs(row["a11"] - 3.40282) < 1e-6 and row["a12"] is None
    assert row["a13"] == 1.5 and row["a15"] == decimal.Decimal("3.40282") and row["a16"] == decimal.Decimal("0.05000")
    assert row["a17"] == 2024 and row["a18"] == 2 and row["a19"] is None and row["a20"] is None
    assert row["a21"] == "text" and row["a24"] == bytearray(b"\x00\x01") and row["a27"] == bytearray(b"l")


def test_image_keeps_absent_and_null_apart(spark):
    short = {**INSERT, "op_type": "U", "keys": [kv("a1", 4)], "new_data": [kv("a9", 1), kv("a4"), kv("a9", 2)]}
    rows = images.row_images(frame(spark, short)).select(
        "side", images.present_text(F.col("states")).alias("p"), images.null_text(F.col("states")).alias("n"),
        images.present_bits(F.col("states")).alias("pb"), images.null_bits(F.col("states")).alias("nb")).collect()
    assert {(r.side, r.p, r.n, r.pb, r.nb) for r in rows} == {
        ("before", "1", "0", "1", "0"), ("after", "4,9", "1,0", "000100001", "10")}
    # the last of two values wins
    assert images.typed_columns(frame(spark, short), [Field("a9", "BIGINT")]).first()["a9"] == 2


def test_bitmaps_of_a_wide_table(spark):
    wide = [{"name": f"c{i}", "meta": meta("INT")} for i in range(1, 71)]
    record = {**INSERT, "fields": wide, "keys": None, "new_data": [kv("c1", 1), kv("c65", 2), kv("c66"), kv("c70", 3)]}
    row = images.row_images(frame(spark, record)).select(
        images.present_bits(F.col("states")).alias("p"), images.null_bits(F.col("states")).alias("n")).first()
    assert [i for i, bit in enumerate(row.p, 1) if bit == "1"] == [1, 65, 66, 70] and row.n == "0010"


def test_records_without_an_operation_are_somewhere(spark):
    odd = [{**INSERT, "op_type": op, "tx_seq": i} for i, op in enumerate([None, "i", "", "X"])]
    log = frame(spark, INSERT, *DDL_RECORDS, *odd)
    ddl, dml = route(log)
    assert (ddl.count(), dml.count()) == (4, 5)
    usable, refused = normalize.split_refused(log)
    assert (usable.count(), refused.count()) == (5, 4)


def test_record_events_and_classes(spark):
    log = frame(spark, INSERT, *DDL_RECORDS)
    ddl, dml = route(log)
    assert (ddl.count(), dml.count()) == (4, 1)
    assert events.explode_events(log).count() == 4 * 2 + 5
    classes = [r[0] for r in ddl.orderBy("scn").select(normalize.ddl_class()).collect()]
    assert classes == ["create db", "create table", "drop table", "drop db / procedure / function"]
    times = normalize.commit_times(ddl).orderBy("scn").first()
    assert times["original_us"] == 1722493959000068


def test_event_sizes(spark):
    one = {**INSERT, "fields": [FIELDS[0]], "keys": None, "new_data": [kv("a1", 1)]}
    update = {**one, "op_type": "U", "keys": [kv("a1", 1)], "new_data": [kv("a1", 10)], "tx_seq": 39, "scn": 54349495054338}
    plain = {**DDL_RECORDS[1], "ddl_sql": "create table t1 (id int)"}
    sizes = {(r.tx_seq, r.event_ord): r.event_len
             for r in events.sized_events(frame(spark, one, update, plain)).collect()}
    assert sizes[38, 1] == 80 and sizes[38, 2] == 38 + 2
    # 19 + 8, two names with length and end, column count, one type, no metadata, its length, NULL map
    assert sizes[38, 3] == 27 + 2 * (1 + 2 + 1) + 1 + 1 + 0 + 1 + 1
    assert sizes[38, 4] == 19 + 10 + 1 + (1 + 1 + 4)
    assert sizes[39, 4] == 19 + 10 + 1 + 2 * (1 + 1 + 4)
    assert sizes[38, 5] == 27
    assert sizes[33, 2] == 33 + 45 + 2 + 2 + len("create table t1 (id int)")


def test_sizes_count_string_bytes_and_skip_nulls(spark):
    fields = [{"name": "v", "meta": meta("VARCHAR", 254)}, {"name": "w", "meta": meta("VARCHAR", 255)},
              {"name": "b", "meta": meta("BLOB")}, {"name": "n", "meta": meta("INT")}]
    record = {**INSERT, "fields": fields, "new_data": [kv("n"), kv("b", b64("abc")), kv("w", b64("é")), kv("v", b64("xy"))]}
    sizes = {r.event_ord: r.event_len for r in events.sized_events(frame(spark, record)).collect()}
    assert sizes[4] == 19 + 10 + 1 + (1 + 1) + (1 + 2) + (2 + 2) + (2 + 3)


def test_refused_records(spark):
    bad = [
        {**INSERT, "op_type": "X", "tx_seq": 1}, {**INSERT, "tx_seq": 2, "new_data": [kv("zz", 1)]},
        {**INSERT, "tx_seq": 3, "msg_time": "2024/08/01 14:32:41"}, {**INSERT, "tx_seq": 4, "check_point": "1-2"},
        {**INSERT, "tx_seq": 5, "check_point": None}, {**INSERT, "tx_seq": 6, "fields": [{"name": "a1", "meta": meta("GEOMETRY")}],
                                                       "new_data": [kv("a1", 1)]},
        {**INSERT, "tx_seq": 7, "fields": [FIELDS[0]], "new_data": [kv("a1", 1), kv("a1", 2)]},
    ]
    usable, refused = normalize.split_refused(frame(spark, INSERT, *DDL_RECORDS, *bad))
    assert usable.count() == 5
    assert {r.tx_seq: r.reasons for r in refused.collect()} == {
        1: ["UNKNOWN_OP"], 2: ["SCHEMA_FIELD_NOT_EXIST"], 3: ["BAD_TIME"], 4: ["INVALID_CHECKPOINT"],
        5: ["INVALID_CHECKPOINT"], 6: ["UNKNOWN_TYPE"], 7: ["TOO_MANY_VALUES"]}


def test_log_files_round_trip(spark, tmp_path):
    log = frame(spark, INSERT, *DDL_RECORDS)
    for fmt in ("parquet", "json"):
        path = str(tmp_path / fmt)
        write_change_log(log, path, fmt)
        write_change_log(log.limit(0), path, fmt)
        back = read_change_log(spark, path, fmt)
        assert back.schema == CHANGE_SCHEMA
        assert sorted(map(repr, back.collect())) == sorted(map(repr, log.collect()))


def test_scan_reads_only_what_is_asked(spark, tmp_path):
    path = str(tmp_path / "log")
    write_change_log(frame(spark, INSERT, *DDL_RECORDS), path)
    plan = read_change_log(spark, path).filter(F.col("scn") > 54349495054337).select("tx_seq")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<scn:bigint,tx_seq:bigint>" in plan and "GreaterThan(scn,54349495054337)" in plan


@pytest.mark.parametrize("width", [1, 15, 16, 17, 40])
def test_event_sizes_of_any_width(spark, width):
    """Tables and images up to and beyond the length that is sized without lambdas; repeated, NULL and odd values."""
    rng = random.Random(width)
    kinds = [("BIGINT", 0, 8, False), ("VARCHAR", 300, 2, True), ("CHAR", 9, 1, True), ("INT", 0, 4, False), ("NEVER", 0, 0, False)]
    chosen = [rng.choice(kinds) for _ in range(width)]
    fields = [{"name": f"c{i}", "meta": meta(k[0], k[1])} for i, k in enumerate(chosen)]

    def value(i):
        kind = rng.choice([None, rng.randrange(99), "x" * rng.randrange(9)])
        return kv(f"c{i}", b64(kind) if isinstance(kind, str) else kind), 0 if kind is None else chosen[i][2] + (
            len(kind) if isinstance(kind, str) and chosen[i][3] else 0)

    def image(repeats):
        if rng.random() < 0.2:
            return None, 0
        stated = [(i, *value(i)) for i in rng.sample(range(width), rng.randint(0, width))]
        if repeats and stated:
            stated += [(i, *value(i)) for i in rng.choices([s[0] for s in stated], k=3)]
        last = {i: n for i, _, n in stated}
        return [v for _, v, _ in stated], (width + 7) // 8 + (len(last) + 7) // 8 + sum(last.values())

    records, expected = [], {}
    for n in range(40):
        (keys, a), (new, b) = image(n % 3 == 0), image(n % 4 == 0)
        records.append({**INSERT, "fields": fields, "keys": keys, "new_data": new, "tx_seq": n})
        expected[n] = 30 + a + b
    found = events.sized_events(spark.createDataFrame(records, CHANGE_SCHEMA), ("tx_seq",)).filter("event_ord = 4").collect()
    assert {r.tx_seq: r.event_len for r in found} == expected


def test_event_sizes_build_no_values_they_do_not_read(spark):
    """The structs of an image are not put together to size a record."""
    log = derive.lineitem_log(spark, "/root/testdata/sf0.001")
    plan = events.event_sizes(log).select("tx_seq", "ends")._jdf.queryExecution().optimizedPlan().toString()
    assert "l_shipdate" in plan and "named_struct" not in plan


def test_parts_are_counted_in_one_pass(spark, tmp_path):
    names = [f["name"] for f in FIELDS]
    bad = [{**INSERT, "op_type": op} for op in (None, "i", "", "X")] + [
        {**INSERT, "fields": [{"name": n, "meta": meta(kind)} for n in names]} for kind in (None, "GEOMETRY")]
    log = frame(spark, INSERT, *DDL_RECORDS, *bad)
    ddl, dml = route(log)
    usable, refused = normalize.split_refused(log)
    parts = {"all": log, "ddl": ddl, "dml": dml, "usable": usable, "refused": refused}
    assert {r.part: r.n for r in normalize.count_parts(log).collect()} == {k: p.count() for k, p in parts.items()} == {
        "all": 11, "ddl": 4, "dml": 7, "usable": 5, "refused": 6}
    assert {r.part: r.n for r in normalize.count_parts(log.limit(0)).collect()} == dict.fromkeys(parts, 0)
    spark.sql("""SELECT id AS o_orderkey, id AS o_custkey, 'O' AS o_orderstatus, 1.5D AS o_totalprice,
        TIMESTAMP_NTZ '1995-01-01 00:00:00' AS o_orderdate, '5-LOW' AS o_orderpriority FROM range(9)""").write.parquet(f"{tmp_path}/orders.parquet")
    counted = QUERIES["odd_operations"](spark, str(tmp_path))
    assert counted._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert {r.part: r.n for r in counted.collect()} == {"all": 18, "ddl": 0, "dml": 18, "usable": 13, "refused": 5}
