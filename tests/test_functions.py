import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import ids, numeric, text, time, types


def values(spark, kind, inputs, function):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[1] for r in sorted(frame.select("i", function(F.col("v"))).collect())]


def test_commit_micros(spark):
    got = values(spark, "string", [
        "2024-08-01 14:32:39.000068", "2024-08-01 14:32:39", "2024-08-01 14:32:39.5", "2024-08-01 14:32:39.1234567",
        "2024-08-01 14:32:39.", "2024/08/01 14:32:39", "2024-08-01T14:32:39", "2024-13-01 00:00:00", "2024-08-01 24:00:00", None],
        time.commit_micros)
    base = 1722493959000000
    assert got == [base + 68, base, base + 500000, base + 123456, base, None, None, None, None, None]
    assert values(spark, "long", [base + 68, -1], time.commit_text) == ["2024-08-01 14:32:39.000068", "1970-01-01 07:59:59.999999"]


def test_parse_checkpoint(spark):
    got = values(spark, "string", ["31-1-54348795023361", "1-2", "1-2-3-4", "1-2-", "a-2-3", "1-4294967298-3", ""],
                 ids.parse_checkpoint)
    assert [tuple(map(int, g)) if g else None for g in got] == [
        (31, 1, 54348795023361), None, None, (1, 2, 0), None, (1, 2, 3), None]


def test_segment_names(spark):
    assert values(spark, "string", ["ON.000001", "ON.index", "ON.1234567", "XX.000001", "ON.12.bak"], ids.segment_number) == [
        1, None, 1234567, None, 12]
    assert values(spark, "long", [1, 1234567], ids.segment_name) == ["ON.000001", "ON.1234567"]


def test_base64(spark):
    assert values(spark, "string", ["YQ==", " Y Q\n==", "Y*==", ""], text.decode_text) == ["a", "a", None, ""]
    line = values(spark, "string", ["x" * 100], lambda c: text.encode_text(c, 76))[0]
    assert [len(part) for part in line.split("\n")] == [76, 60]


def test_json(spark):
    inputs = ['{"a": 1}', '[1]', '{"a"', '"k": 0}', "7", '{"a": 1} x']
    got = values(spark, "string", inputs, lambda c: text.json_text(text.encode_text(c)))
    assert got == ['{"a": 1}', "[1]", None, None, "7", None]


def test_time_text(spark):
    second = 1_000_000
    got = values(spark, "string", [
        "10:11:12", "-10:11", "838:59:59", "839:00:00", "1 02:03:04", "2 3", "101112", "1112", "12", "5", "1234559", "1234567",
        "10:11:12.5", "10:60:00", "1.25", "abc", "", " -0:00:01", "101112.000001"], time.time_micros)
    assert got == [
        36672 * second, -36660 * second, 3020399 * second, None, 93784 * second, 2 * second, 36672 * second, 672 * second,
        12 * second, 5 * second, 445559 * second, None, 36672 * second + 500000, None, second + 250000, None, None, -second,
        36672 * second + 1]
    assert values(spark, "string", ["838:59:59"], time.parse_time) == [datetime.timedelta(hours=838, minutes=59, seconds=59)]


def test_datetime_text(spark):
    got = values(spark, "string", [
        "2024-08-01 14:32:39.5", "24-8-1", "70-01-01", "69-01-01", "20240801", "240801", "20240801143239",
        "20240801T143239", "240801143239", "2024/08/01 14.32.39", "2024-08-01T14:32", "2024-02-30", "2024", "2024-08", "x",
        "0000-00-00", "2024-08-01 25:00:00", "2024-08-01 14:32:39.1234567", "2024-08-01 14:32:39+08:00"], time.parse_datetime)
    d = datetime.datetime
    assert got == [
        d(2024, 8, 1, 14, 32, 39, 500000), d(2024, 8, 1), d(1970, 1, 1), d(2069, 1, 1), d(2024, 8, 1), d(2024, 8, 1),
        d(2024, 8, 1, 14, 32, 39), d(2024, 8, 1, 14, 32, 39), d(2024, 8, 1, 14, 32, 39), d(2024, 8, 1, 14, 32, 39),
        d(2024, 8, 1, 14, 32), None, None, None, None, None, None, d(2024, 8, 1, 14, 32, 39, 123456), d(2024, 8, 1, 14, 32, 39)]


def test_zone_offset(spark):
    assert values(spark, "string", ["+08:00", "-03:30", "+14:00", "+14:01", "-00:00", "+00:00", "+08:60", "08:00", "+8:00",
                                    "+08:00 "], time.zone_offset_seconds) == [
        28800, -12600, 50400, None, None, 0, None, None, None, 28800]


def test_local_epoch_and_day_number(spark):
    got = values(spark, "timestamp_ntz", [datetime.datetime(1970, 1, 1, 8), datetime.datetime(1970, 1, 1), datetime.datetime(3002, 1, 1)],
                 lambda c: time.local_epoch(c, "+08:00"))
    assert got == [0, 0, 0]
    assert values(spark, "date", [datetime.date(1970, 1, 1), datetime.date(2000, 1, 1)], time.day_number) == [719528, 730485]


@pytest.mark.parametrize("bits", [8, 16, 24, 32, 64])
def test_integer_widths(spark, bits):
    inputs = [0, 1, -1, (1 << (bits - 1)) - 1, -(1 << (bits - 1)), 12345678901, -98765432109]
    low = [v & ((1 << bits) - 1) for v in inputs]
    signed = [v - (1 << bits) if v >> (bits - 1) else v for v in low]
    assert values(spark, "long", inputs, lambda c: numeric.narrow_int(c, bits)) == signed
    assert [int(v) for v in values(spark, "long", inputs, lambda c: numeric.unsigned_int(c, bits))] == low


def test_fixed_width_numbers(spark):
    assert values(spark, "double", [3.402820110321045, 12345.678, -0.5], lambda c: numeric.fixed_width_text(c, 10, 5)) == [
        "3.40282", None, "-0.50000"]
    assert values(spark, "double", [12345.678], lambda c: numeric.fixed_width_number(c, 0, 2)) == [12345.68]
    # binary values a little under and exactly at a half, and one beyond any decimal
    assert values(spark, "double", [1.005, 2.675, 0.125, 1e40], lambda c: F.substring(numeric.fixed_width_text(c, 0, 2), 1, 5)) == [
        "1.00", "2.67", "0.12", "10000"]


def test_decimals(spark):
    assert [str(v) for v in values(spark, "string", ["0.05000", "1.2345678", "x"], lambda c: numeric.decimal_value(c, 10, 5))] == [
        "0.05000", "1.23457", "None"]
    assert str(values(spark, "string", ["-1.2345678"], lambda c: numeric.decimal_value(c, 10, 5, "trunc"))[0]) == "-1.23456"
    assert values(spark, "string", ["1" * 50], lambda c: numeric.decimal_value(c, 65, 0)) == ["1" * 50]
    assert values(spark, "int", [0, 1, 9, 10, 20], lambda c: numeric.decimal_bytes(c, F.lit(0))) == [0, 1, 4, 5, 9]


def test_labels(spark):
    labels = F.array(*[F.lit(x) for x in ("dd", "ee", "ff")])
    assert values(spark, "long", [0, 1, 3, 4, -1], lambda c: numeric.enum_label(labels, c)) == ["", "dd", "ff", None, None]
    assert values(spark, "long", [0, 5, 7], lambda c: numeric.set_labels(labels, c)) == [[], ["dd", "ff"], ["dd", "ee", "ff"]]
    assert values(spark, "long", [5], lambda c: numeric.bit_text(c, 23)) == ["00000000000000000000101"]


def test_uuids_and_gtids(spark):
    u = "0123456789ab-cdef"
    full = "01234567-89ab-cdef-0123-456789abcdef"
    assert values(spark, "string", [full.upper(), "{" + full + "}", full.replace("-", ""), u, "{" + full, full + "0"],
                  ids.normalize_uuid) == [full, full, full, None, None, None]
    got = values(spark, "string", [full + ":1", f" {full} : 7 ", full + ":0", full + ":9223372036854775807", full + ":-1"], ids.parse_gtid)
    assert [tuple(g) if g else None for g in got] == [(full, 1), (full, 7), None, None, None]


def test_widths_and_metadata(spark):
    declared = [("CHAR", 20, 0), ("VARCHAR", 254, 0), ("VARCHAR", 255, 0), ("DECIMAL", 10, 5), ("BIT", 23, 0), ("ENUM", 256, 0),
                ("SET", 33, 0), ("LONGBLOB", 0, 0), ("JSON", 0, 0), ("DOUBLE", 20, 10), ("INT", 0, 0), ("CHAR", 256, 0), ("GEOMETRY", 0, 0)]
    frame = spark.createDataFrame([(i, *d) for i, d in enumerate(declared)], "i int, d string, n int, p int")
    first, second = types.metadata_bytes(F.col("d"), F.col("n"), F.col("p"))
    rows = sorted(frame.select("i", types.storage_bytes(F.col("d"), F.col("n"), F.col("p")), first, second,
                               types.metadata_size(F.col("d"))).collect())
    assert [tuple(r)[1:] for r in rows] == [
        (1, 254, 80, 2), (1, 254, 0, 2), (2, 255, 0, 2), (6, 10, 5, 2), (3, 7, 2, 2), (2, 247, 2, 2), (8, 248, 8, 2), (4, 4, None, 1),
        (4, 4, None, 1), (8, 8, None, 1), (4, None, None, 0), (2, 238, 0, 2), (None, None, None, 0)]


def test_new_type_handler(spark):
    @types.register_type("POINT_TEXT")
    def _(kv, field):
        return F.upper(text.decode_text(kv["string_val"]))

    frame = spark.createDataFrame([("eA==",)], "string_val string").select(F.struct("string_val").alias("kv"))
    assert frame.select(types.typed_value(F.col("kv"), types.Field("p", "POINT_TEXT"))).first()[0] == "X"
    with pytest.raises(KeyError):
        types.typed_value(F.col("kv"), types.Field("p", "NO_SUCH"))


def test_commit_text_is_plain_expressions(spark):
    micros = spark.sql("SELECT explode(array(0L, -1L, 57599999999L, 57600000000L, NULL)) AS m")
    text = micros.select(time.commit_text(micros["m"]).alias("t"))
    assert [r.t for r in text.collect()] == [
        "1970-01-01 08:00:00.000000", "1970-01-01 07:59:59.999999", "1970-01-01 23:59:59.999999", "1970-01-02 00:00:00.000000",
        time.NO_CLOCK]
    assert text.select(time.commit_micros(text["t"]).alias("m")).collect()[-1].m is None
    assert "format_string" not in text._jdf.queryExecution().optimizedPlan().toString()
