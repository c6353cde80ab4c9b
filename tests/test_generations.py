"""Definitions in replay, history, before images and conflicts against applying one record after the other."""

import random

import pytest
from pyspark.sql import functions as F
from records import ddl
from test_replay import KEY, SPEC, record

from tidemark.operators import generations, replay
from tidemark.schema import CHANGE_SCHEMA


def definition(tx, db, table, sql, kind=None):
    return ddl(f"{tx}-1-{tx}", db, table, sql, kind, tx, tx, "2024-08-01 14:32:41.000054", "2024-08-01 14:32:41.000054", tx - 1, tx)


def change(tx, table, op, k, new=None, db="shop"):
    own = record(tx, op, None if op == "I" else k, None if op == "D" else ({"id": k} if op == "I" else {}) | (new or {}))
    return {**own, "db_name": db, "table_": table}


def random_log(seed, n=900):
    rng, out = random.Random(seed), []
    for tx in range(1, n + 1):
        kind, table = rng.random(), rng.choice(["t", "t", "t", "old", "new"])
        if kind < 0.02:
            sql, what = rng.choice([
                ("truncate table t", None), ("TRUNCATE `t`", None), ("drop table if exists `old`, shop.t", "DROP TABLE"),
                ("drop database shop", None), ("rename table t to gone, old to t", None), ("RENAME TABLE shop.new TO shop.old", None),
                ("alter table `old` rename to t", None), ("create table t (id int)", "CREATE TABLE"), ("alter table t add column t int", None),
                ("drop database other", None), ("create procedure t() begin end", None)])
            named = None if "database" in sql or "procedure" in sql else "shop"
            own = None if named is None or sql.lower().startswith(("rename", "alter", "drop")) else "t"
            out.append(definition(tx, named, own, sql, what))
        elif kind < 0.4:
            out.append(change(tx, table, "I", rng.randrange(12), {"a": rng.randrange(99)}))
        elif kind < 0.55:
            out.append(change(tx, table, "D", rng.randrange(12)))
        else:
            out.append(change(tx, table, "U", rng.randrange(12), {"a": rng.randrange(99)} if rng.random() < 0.5 else {"b": "v%d" % tx}))
    return out


def sequential(records, name="t", base=()):
    """Stores by name, each with its rows and what happened in it; a rename takes the store along."""
    def new():
        return {"rows": {}, "history": {}, "before": {}, "conflicts": {}}

    stores = {name: new() | {"rows": dict(base)}}
    out = {"history": {}, "before": {}, "conflicts": {}}

    def close(table):
        if table == name and table in stores:
            for c in out:
                out[c] |= stores[table][c]
        return stores.pop(table, new())

    for r in sorted(records, key=lambda r: r["tx_seq"]):
        tx, sql = r["tx_seq"], (r["ddl_sql"] or "").lower().replace("`", "").replace("shop.", "")
        if r["op_type"] == "DDL":
            if sql.startswith("truncate") or sql.startswith("create table"):
                close("t")
            elif sql.startswith("drop table"):
                close("old"), close("t")
            elif sql == "drop database shop":
                for table in list(stores):
                    close(table)
            elif sql.startswith("rename table t to gone"):
                stores["gone"] = close("t")
                stores["t"] = stores.pop("old", new())
            elif sql.startswith("rename table new"):
                close("old")
                stores["old"] = stores.pop("new", new())
            elif sql.startswith("alter table old rename"):
                close("t")
                stores["t"] = stores.pop("old", new())
            continue
        store = stores.setdefault(r["table_"], new())
        values = {e["key"]: e["long_val"] if e["key"] != "b" else "v%d" % tx for e in r["new_data"] or []}
        k = values["id"] if r["op_type"] == "I" else r["keys"][0]["long_val"]
        rows, op, live = store["rows"], r["op_type"], None
        live = k in rows
        if op == "I":
            if live:
                store["conflicts"][tx] = "insert_exists"
            rows[k] = (values.get("a"), values.get("b"))
            store["history"][tx] = rows[k]
        elif not live:
            store["conflicts"][tx] = "update_missing" if op == "U" else "delete_missing"
        else:
            store["before"][tx] = rows[k]
            if op == "D":
                del rows[k]
            else:
                rows[k] = (values.get("a", rows[k][0]), values.get("b", rows[k][1]))
                store["history"][tx] = rows[k]
    table = dict(stores.get(name, new())["rows"])
    close(name)
    return table, out


@pytest.mark.parametrize("seed", [1])
def test_definitions_equal_sequential(spark, seed):
    records = random_log(seed)
    shuffled = records[:]
    random.Random(seed).shuffle(shuffled)
    log = spark.createDataFrame(shuffled, CHANGE_SCHEMA).repartition(4).cache()
    base_rows = {k: (k * 10, f"base{k}") for k in range(0, 12, 2)}
    base = spark.createDataFrame([(k, a, b) for k, (a, b) in base_rows.items()], "id long, a long, b string")
    table, expected = sequential(records, base=base_rows.items())
    asked = (log, "shop", "t", SPEC, KEY, base)
    assert {r.tx_seq: (r.a, r.b) for r in generations.row_history(*asked).collect()} == expected["history"]
    assert {r.tx_seq: (r.a, r.b) for r in generations.before_images(*asked).collect()} == expected["before"]
    assert {r.tx_seq: r.reason for r in generations.replay_conflicts(*asked).collect()} == expected["conflicts"]
    got = generations.replay_table(base, log, "shop", "t", SPEC, KEY).collect()
    assert {r.id: (r.a, r.b) for r in got} == table
    # the same table from key states written without the definitions, as a stream does
    changes = generations.table_changes(log, "shop", "t", SPEC, KEY)
    ended = generations.resets(log, "shop", "t").agg(F.max("at").alias("at"))
    if not any("old to t" in (r["ddl_sql"] or "") or "old` rename" in (r["ddl_sql"] or "") for r in records):
        states = replay.key_states(changes.drop("generation"), KEY)
        assert {r.id for r in replay.apply_net(base.limit(0), replay.settle(states, KEY, ended), KEY).collect()} == set(table)


def test_insert_after_drop_and_create_is_no_conflict(spark):
    records = [change(1, "t", "I", 1, {"a": 1}), definition(2, "shop", "t", "drop table t", "DROP TABLE"),
               definition(3, "shop", "t", "create table t (id int)", "CREATE TABLE"), change(4, "t", "I", 1, {"a": 2}), change(5, "t", "U", 1, {"b": "v5"})]
    log = spark.createDataFrame(records, CHANGE_SCHEMA)
    assert generations.replay_conflicts(log, "shop", "t", SPEC, KEY).count() == 0
    assert {(r.tx_seq, r.a, r.b) for r in generations.before_images(log, "shop", "t", SPEC, KEY).collect()} == {(5, 2, None)}


def test_definitions_of_several_tables(spark):
    records = [definition(1, "d", None, "rename table a to `b c`, x.y to z"), definition(2, "d", "q", "drop table a, x.`b`", "DROP TABLE"),
               definition(3, None, None, "drop schema if exists `My_db`;"), definition(4, "d", None, "alter table a add column r int, rename as w"),
               definition(5, "d", "t", "alter table t rename column a to b"), definition(6, "d", "t", "insert", "CREATE TABLE")]
    got = generations.definitions(spark.createDataFrame(records, CHANGE_SCHEMA)).collect()
    assert sorted((r["at"].tx_seq, r.kind, r.db, r.name, r.to_db, r.to_name) for r in got if r["name"]) == [
        (1, "rename", "d", "a", "d", "b c"), (1, "rename", "x", "y", "d", "z"), (2, "drop", "d", "a", None, None), (2, "drop", "d", "q", None, None),
        (2, "drop", "x", "b", None, None), (4, "rename", "d", "a", "d", "w"), (6, "create", "d", "t", None, None)]
    assert [(r["at"].tx_seq, r.kind, r.db) for r in got if not r["name"]] == [(3, "drop database", "My_db")]


def test_few_resets_need_no_running_total(spark, monkeypatch):
    """Changes find their generation among the resets, at their own place as well; beyond a number of resets by a total."""
    records = [change(1, "t", "I", 1, {"a": 1}), definition(1, "shop", "t", "truncate table t"), change(2, "t", "I", 1, {"a": 2}),
               definition(3, "shop", "t", "truncate table t"), {**change(3, "t", "I", 1, {"a": 3}), "dn": None},
               definition(4, "shop", "u", "truncate table u"), {**change(4, "t", "D", 1), "scn": None},
               definition(5, "shop", "t", "drop table t", "DROP TABLE"), change(6, "t", "I", 1, {"a": 6})]
    log = spark.createDataFrame(records, CHANGE_SCHEMA).repartition(3).cache()

    def numbered():
        changes = generations.table_changes(log, "shop", "t", SPEC, KEY)
        return {(r.scn, r.tx_seq, r.op): r.generation for r in changes.collect()}, changes._jdf.queryExecution().optimizedPlan().toString()

    found, plan = numbered()
    assert "Window" not in plan and set(found.values()) == {0, 1, 2, 3}
    assert found[(2, 2, "I")] == 1 and found[(3, 3, "I")] == 2 and found[(None, 4, "D")] == 0 and found[(6, 6, "I")] == 3
    monkeypatch.setattr(generations, "SENT_RESETS", 2)
    totalled, plan = numbered()
    assert "Window" in plan and totalled == found
