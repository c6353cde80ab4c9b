import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.scans import add_buckets, carry_forward, hot_keys, numbered, running_total


def rows(n, seed):
    """Rows of which a third share one transaction and a third share one key, in random order."""
    rng = random.Random(seed)
    out = [(7 if i % 3 == 0 else rng.randrange(50), i, 1 if i % 3 == 1 else rng.randrange(40), rng.choice([None, rng.randrange(9)]))
           for i in range(n)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("buckets", [1, 3, 8, 500, None])
def test_running_total(spark, buckets):
    data = rows(900, 1)
    frame = spark.createDataFrame(data, "tx long, lsn long, k long, v long").repartition(5)
    got = running_total(frame, [F.col("tx"), F.col("lsn")], {"total": F.col("v"), "n": F.lit(1)}, buckets)
    expected, total = {}, 0
    for i, (tx, lsn, _, v) in enumerate(sorted(data, key=lambda r: r[:2])):
        total += v or 0
        expected[lsn] = (total, i + 1)
    assert {r.lsn: (r.total, r.n) for r in got.collect()} == expected
    assert got.columns == ["tx", "lsn", "k", "v", "total", "n"]


def test_numbers_of_nothing(spark):
    assert numbered(spark.createDataFrame([], "a long"), [F.col("a")]).count() == 0


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("hot_rows", [20, 100, 10_000])
def test_carry_forward(spark, strict, hot_rows):
    data = rows(900, 2)
    frame = spark.createDataFrame(data, "tx long, lsn long, k long, v long").repartition(4)
    got = carry_forward(frame, ["k"], [F.col("tx"), F.col("lsn")], {"last": F.col("v")}, strict, hot_rows)
    expected, held = {}, {}
    for tx, lsn, k, v in sorted(data, key=lambda r: r[:2]):
        before = held.get(k)
        if v is not None:
            held[k] = v
        expected[lsn] = before if strict else held.get(k)
    assert {r.lsn: r.last for r in got.collect()} == expected


def test_carry_forward_with_a_null_key(spark):
    data = [(i, None if i % 2 else 1, i if i % 5 == 0 else None) for i in range(200)]
    frame = spark.createDataFrame(data, "i long, k long, v long")
    got = {r.i: r.last for r in carry_forward(frame, ["k"], [F.col("i")], {"last": F.col("v")}, hot_rows=10).collect()}
    held = {}
    for i, k, v in data:
        held[k] = v if v is not None else held.get(k)
        assert got[i] == held[k]


def test_only_busy_keys_are_split(spark):
    frame = spark.createDataFrame(rows(900, 3), "tx long, lsn long, k long, v long")
    assert hot_keys(frame, ["k"], 200).count() == 1
    assert hot_keys(frame, ["k"], 10_000).count() == 0
    many = spark.range(40_000).select((F.col("id") % 20_000).alias("k"))
    assert hot_keys(many, ["k"], 2).count() == 20_000
    plan = carry_forward(frame, ["k"], [F.col("lsn")], {"last": F.col("v")}, hot_rows=10_000)._jdf.queryExecution().toString()
    assert "single partition" not in plan.lower() and "SinglePartition" not in plan


def test_buckets_follow_the_order_and_the_rows(spark):
    data = rows(3000, 4)
    frame = spark.createDataFrame(data, "tx long, lsn long, k long, v long")
    order = [F.col("tx"), F.col("lsn")]
    got = sorted(map(tuple, add_buckets(frame.repartition(7), order, 12).select("tx", "lsn", "_bucket").collect()))
    numbers = [b for *_, b in got]
    assert numbers == sorted(numbers) and 10 <= len(set(numbers)) <= 13 and numbers[0] == 0
    assert max(numbers.count(b) for b in set(numbers)) < 3 * 3000 / 12  # a transaction of a third of the rows is split
    again = add_buckets(frame.repartition(2).orderBy(F.rand()), order, 12).select("tx", "lsn", "_bucket").collect()
    assert sorted(map(tuple, again)) == got
    one = spark.createDataFrame([(1, 2)] * 50, "tx long, lsn long")
    assert {r._bucket for r in add_buckets(one, order, 12).collect()} <= {0, 1}


def test_buckets_of_other_orders(spark):
    """Structs, texts, times with microseconds, NULLs and a column that is named like a bound."""
    frame = spark.sql("""SELECT named_struct('a', id % 5, 'b', if(id % 7 = 0, NULL, id)) AS s, if(id % 3 = 0, NULL, concat('é"', id % 9)) AS all,
        timestamp_micros(id * 333333) AS g, id FROM range(400)""")
    order = [F.col("s"), F.col("all"), F.col("g")]
    placed = {r.id: r.pos for r in numbered(frame, order, buckets=9).collect()}
    assert [r.id for r in frame.orderBy(*order).collect()] == sorted(placed, key=placed.get)


def test_running_total_keeps_nothing(spark):
    """One job before the action, no checkpoint, no cached rows, no Python, no single task that holds rows."""
    frame = spark.createDataFrame(rows(900, 5), "tx long, lsn long, k long, v long")
    spark.sparkContext.setJobGroup("lazy", "lazy")
    total = running_total(frame, [F.col("tx"), F.col("lsn")], {"total": F.col("v")}, 8)
    # Spark runs one or two jobs for an adaptive aggregate: its shuffle stage and its result
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")) <= 3
    spark.sparkContext.setJobGroup("rest", "rest")
    plan = total._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "InMemory", "ExistingRDD LocalCheckpoint"))


def test_busy_keys_never_meet_in_one_task(spark):
    """Rows are not shuffled by the hash of a busy key, also where Spark would not broadcast the hashes by itself."""
    frame = spark.range(4000).select(F.col("id"), (F.col("id") % 2).alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        carried = carry_forward(frame, ["k"], [F.col("id")], {"last": F.col("id")}, strict=True, hot_rows=100, buckets=8)
        plan = carried._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        assert all(r.last == (r.id - 2 if r.id > 1 else None) for r in carried.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bisection_is_generated_code(spark):
    frame = spark.createDataFrame(rows(900, 7), "tx long, lsn long, k long, v long")
    plan = add_buckets(frame, [F.col("tx"), F.col("lsn")], 12)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan


def test_running_total_shuffles_rows_once_whatever_is_read(spark):
    frame = spark.createDataFrame([(i, i % 7, f"text {i}") for i in range(500)], "tx long, v long, unread string").repartition(3)
    got = running_total(frame, [F.col("tx")], {"total": F.col("v")}, 4).select("total")
    assert got.agg(F.max("total")).first()[0] == sum(i % 7 for i in range(500))
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan
