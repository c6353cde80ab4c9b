import random

import pytest
from pyspark.sql import functions as F
from records import INSERT, b64, kv, meta

from tidemark.functions.types import Field
from tidemark.operators import replay
from tidemark.schema import CHANGE_SCHEMA

SPEC = [Field("id", "BIGINT", nullable=False), Field("a", "BIGINT"), Field("b", "TEXT")]
FIELDS = [{"name": f.name, "meta": meta(f.data_type)} for f in SPEC]
KEY = ["id"]


def record(tx, op, keys, new):
    return {**INSERT, "fields": FIELDS, "op_type": op, "tx_seq": tx, "scn": tx, "lsn": tx, "seq": 1, "dn": 0,
            "keys": [kv("id", keys)] if keys is not None else None,
            "new_data": None if new is None else [kv(c, b64(v) if isinstance(v, str) else v) for c, v in new.items()]}


def random_log(n, keys, seed):
    """Inserts, deletes, partial updates and key moves; a third of the changes hit key 0."""
    rng = random.Random(seed)
    out = []
    for tx in range(1, n + 1):
        k = 0 if rng.random() < 0.33 else rng.randrange(keys)
        kind = rng.random()
        row = {"a": rng.choice([None, rng.randrange(99)]), "b": rng.choice([None, "v%d" % tx])}
        some = {c: v for c, v in row.items() if rng.random() < 0.6}
        if kind < 0.25:
            out.append(record(tx, "I", None, {"b": row["b"], "id": k} | ({"a": row["a"]} if rng.random() < 0.8 else {})))
        elif kind < 0.4:
            out.append(record(tx, "D", k, None))
        elif kind < 0.45:
            out.append(record(tx, "U", k, {**row, "id": rng.randrange(keys)}))
        else:
            out.append(record(tx, "U", k, some))
    return out


def steps(records):
    """Row changes in order, key moves split."""
    for r in sorted(records, key=lambda r: r["tx_seq"]):
        new = None if r["new_data"] is None else {
            e["key"]: e["long_val"] if e["key"] != "b" else (None if e["string_val"] is None else
                                                              __import__("base64").b64decode(e["string_val"]).decode())
            for e in r["new_data"]}
        old = r["keys"][0]["long_val"] if r["keys"] else None
        if r["op_type"] == "U" and new.get("id", old) != old:
            yield r["tx_seq"], 0, "D", old, None
            yield r["tx_seq"], 1, "I", new["id"], {c: v for c, v in new.items() if c != "id"}
        else:
            yield r["tx_seq"], 0, r["op_type"], new["id"] if r["op_type"] == "I" else old, (
                None if new is None else {c: v for c, v in new.items() if c != "id"})


def sequential(records, base):
    """Apply one change after the other; returns table, history, before images and conflicts."""
    table, history, before, conflicts = dict(base), {}, {}, {}
    for tx, sub, op, k, new in steps(records):
        live = k in table
        if op == "I":
            if live:
                conflicts[tx, sub] = "insert_exists"
            table[k] = (new.get("a"), new.get("b"))
            history[tx, sub] = table[k]
        elif not live:
            conflicts[tx, sub] = "update_missing" if op == "U" else "delete_missing"
        else:
            before[tx, sub] = table[k]
            if op == "D":
                del table[k]
            else:
                a, b = table[k]
                table[k] = (new.get("a", a), new.get("b", b))
                history[tx, sub] = table[k]
    return table, history, before, conflicts


BASE = {k: (k * 10, f"base{k}") for k in range(0, 30, 2)}


@pytest.fixture(scope="module")
def world(spark):
    records = random_log(1500, 30, 11)
    shuffled = records[:]
    random.Random(1).shuffle(shuffled)
    log = spark.createDataFrame(shuffled, CHANGE_SCHEMA).repartition(6).cache()
    base = spark.createDataFrame([(k, a, b) for k, (a, b) in BASE.items()], "id long, a long, b string")
    return records, log, base


@pytest.mark.parametrize("with_base", [True, False])
def test_replay_equals_sequential(spark, world, with_base):
    records, log, base = world
    start = BASE if with_base else {}
    frame = base if with_base else base.limit(0)
    table, *_ = sequential(records, start)
    got = replay.replay(frame, log, SPEC, KEY)
    assert {r.id: (r.a, r.b) for r in got.collect()} == table
    assert got.columns == ["id", "a", "b"]


@pytest.mark.parametrize("hot_rows", [100, 10_000])
def test_history_and_conflicts_equal_sequential(spark, world, hot_rows):
    records, log, base = world
    _, history, before, conflicts = sequential(records, BASE)
    changes = replay.row_changes(log, SPEC, KEY)
    got = replay.row_history(changes, KEY, base, hot_rows).collect()
    assert {(r.tx_seq, r["sub"]): (r.a, r.b) for r in got} == history
    got = replay.before_images(changes, KEY, base, hot_rows).collect()
    assert {(r.tx_seq, r["sub"]): (r.a, r.b) for r in got} == before
    got = replay.replay_conflicts(changes, KEY, base, hot_rows).collect()
    assert {(r.tx_seq, r["sub"]): r.reason for r in got} == conflicts


def test_states_merge_in_any_order(spark, world):
    records, log, base = world
    changes = replay.row_changes(log, SPEC, KEY)
    parts = [replay.key_states(changes.filter(F.col("tx_seq") % 4 == i), KEY) for i in (2, 0, 3, 1)]
    states = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    merged = replay.merge_states(states.unionByName(parts[0]), KEY)
    got = replay.apply_net(base, replay.settle(merged, KEY), KEY)
    assert {r.id: (r.a, r.b) for r in got.collect()} == sequential(records, BASE)[0]


def test_replay_of_the_log_of_a_table_is_the_table(spark):
    rows = [(i, i * 3, f"row {i}") for i in range(50)]
    log = spark.createDataFrame([record(i + 1, "I", None, {"b": b, "id": i, "a": a}) for i, a, b in rows], CHANGE_SCHEMA)
    expected = spark.createDataFrame(rows, "id long, a long, b string")
    assert replay.reconcile(replay.replay(expected.limit(0), log, SPEC, KEY), expected, KEY).count() == 0


def test_partial_key_moves_are_set_aside(spark):
    log = spark.createDataFrame([record(1, "I", None, {"id": 1, "a": 1, "b": "x"}), record(2, "U", 1, {"id": 2}),
                                 record(3, "U", 1, {"id": 1, "a": 5})], CHANGE_SCHEMA)
    assert [r.tx_seq for r in replay.partial_moves(log, SPEC, KEY).collect()] == [2]
    empty = spark.createDataFrame([], "id long, a long, b string")
    assert [tuple(r) for r in replay.replay(empty, log, SPEC, KEY).collect()] == [(1, 5, "x")]


def test_dropping_a_table_empties_it(spark):
    drop = {**record(2, "DDL", None, None), "ddl_type": "DROP TABLE", "ddl_sql": "drop table t1", "fields": None, "dn": None}
    log = spark.createDataFrame([record(1, "I", None, {"id": 1, "a": 1, "b": "x"}), drop,
                                 record(3, "I", None, {"id": 2, "a": 2, "b": "y"})], CHANGE_SCHEMA)
    assert [r.tx_seq for r in replay.since_last_drop(log, "t1", "t1").collect()] == [3]
    assert replay.since_last_drop(log.filter("op_type <> 'DDL'"), "t1", "t1").count() == 2
    base = spark.createDataFrame([(9, 9, "old")], "id long, a long, b string")
    held = lambda log: sorted(tuple(r) for r in replay.replay_table(base, log, "t1", "t1", SPEC, KEY).collect())
    assert held(log) == [(2, 2, "y")]
    assert held(log.filter("op_type <> 'DDL'")) == [(1, 1, "x"), (2, 2, "y"), (9, 9, "old")]
    for ddl in ("TRUNCATE TABLE t1", "drop  database if exists `T1`"):
        other = {**drop, "ddl_type": None, "ddl_sql": ddl}
        if ddl.startswith("drop"):
            other |= {"db_name": None, "table_": None}
        assert held(spark.createDataFrame([record(1, "I", None, {"id": 1, "a": 1, "b": "x"}), other], CHANGE_SCHEMA)) == []


def test_records_without_a_key_are_left_out(spark):
    log = spark.createDataFrame([record(1, "I", None, {"a": 1, "b": "x"}), record(2, "I", None, {"id": None, "a": 2, "b": "y"}),
                                 record(3, "I", None, {"id": 4, "a": 5, "b": "z"}), record(4, "D", None, None)], CHANGE_SCHEMA)
    assert sorted(r.tx_seq for r in replay.keyless_changes(log, SPEC, KEY).collect()) == [1, 2, 4]
    empty = spark.createDataFrame([], "id long, a long, b string")
    assert [tuple(r) for r in replay.replay(empty, log, SPEC, KEY).collect()] == [(4, 5, "z")]


def test_net_changes_combine_before_the_shuffle(spark, world):
    _, log, _ = world
    plan = replay.net_changes(replay.row_changes(log, SPEC, KEY), KEY)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and plan.count("Exchange hashpartitioning(id") == 1 and "Window" not in plan
