"""Field lists that change along a log."""

import pytest
from records import INSERT, b64, kv, meta

from tidemark.functions.types import Field
from tidemark.operators import images, versions
from tidemark.schema import CHANGE_SCHEMA

LISTS = [
    [("id", meta("INT", nullable=False)), ("price", meta("DECIMAL", 10, 2)), ("note", meta("VARCHAR", 9))],
    [("id", meta("BIGINT", nullable=False)), ("price", meta("DOUBLE")), ("note", meta("VARCHAR", 20)), ("qty", meta("INT", unsigned=True))],
    [("id", meta("BIGINT", nullable=False)), ("price", meta("DOUBLE")), ("qty", meta("INT"))],
    [("id", meta("BIGINT", nullable=False)), ("price", meta("VARCHAR", 20)), ("qty", meta("INT"))],
]


def rec(tx, number, **values):
    listed = None if number is None else [{"name": n, "meta": m} for n, m in LISTS[number]]
    return {**INSERT, "tx_seq": tx, "scn": tx, "lsn": tx, "fields": listed, "new_data": [kv(c, v) for c, v in values.items()]}


def test_one_typed_row_for_each_record(spark):
    log = spark.createDataFrame([
        rec(1, 0, id=1, price="12.50", note=b64("a")), rec(2, None, id=2, price="3.25"), rec(3, 1, id=2**40, price=0.5, note=b64("b"), qty=2**32 - 1),
        rec(4, None, id=4, price=1.5, qty=7), rec(5, 2, id=5, price=2.5, qty=-8), rec(6, 3, id=6, price=b64("free")), rec(7, 1, id=7)], CHANGE_SCHEMA).repartition(3)
    got = {r.tx_seq: r for r in versions.typed_versions(log, "t1", "t1", keep=("tx_seq",)).collect()}
    assert {t: (r.id, r.price, r.note, r.qty) for t, r in got.items()} == {
        1: (1, "12.50", "a", None), 2: (2, "3.25", None, None), 3: (2**40, "0.5", "b", 2**32 - 1), 4: (4, "1.5", None, 7), 5: (5, "2.5", None, -8),
        6: (6, "free", None, None), 7: (7, None, None, None)}
    found = {tuple(f["name"] for f in r.fields): (r.first.tx_seq, r.last.tx_seq, r.n_records) for r in versions.field_versions(log).collect()
             if r.fields[1]["meta"]["data_type"] != "VARCHAR"}
    assert found == {("id", "price", "note"): (1, 1, 1), ("id", "price", "note", "qty"): (3, 7, 2), ("id", "price", "qty"): (5, 5, 1)}
    assert [f.name for f in images.table_fields(log, "t1", "t1")] == ["id", "price", "note", "qty"]
    with pytest.raises(ValueError):
        images.table_fields(log, "t1", "other")


def test_types_are_widened():
    def merged(a, b):
        f = versions.widened(Field("c", *a), Field("c", *b))
        return f.data_type, f.length, f.precision, f.is_unsigned

    assert merged(("INT",), ("BIGINT",)) == ("BIGINT", 0, 0, False)
    assert merged(("TINYINT", 0, 0, True), ("TINYINT",)) == ("SMALLINT", 0, 0, False)
    assert merged(("BIGINT", 0, 0, True), ("INT",)) == ("DECIMAL", 20, 0, False)
    assert merged(("INT", 0, 0, True), ("BIGINT", 0, 0, True)) == ("BIGINT", 0, 0, True)
    assert merged(("VARCHAR", 9), ("VARCHAR", 4)) == ("VARCHAR", 9, 0, False)
    assert merged(("DECIMAL", 10, 2), ("DOUBLE",)) == ("DOUBLE", 0, 0, False)
    assert merged(("DATE",), ("DATETIME",)) == ("DATETIME", 0, 0, False)
    assert merged(("INT",), ("JSON",)) == ("LONGTEXT", 0, 0, False)
