"""Logs that are landed as files for a stream: how many files, in what ranges, and what a sink keeps of them."""

import datetime
import glob

import pytest
from pyspark.sql import functions as F

from tidemark.plans import catalogue, derive, streams  # noqa: F401 (the catalogue first, as it orders the modules)
from tidemark.schema import commit_order

ROWS = [(k, k % 10 if k % 50 else None, "OFP"[k % 3], k * 1.5, datetime.datetime(1995, 1, 1 + k % 28), f"{k % 5}-LOW") for k in range(1, 400)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("orders"))
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(ROWS + ROWS[:20] + [(None, *ROWS[0][1:])], schema).write.parquet(f"{path}/orders.parquet")
    return path


def test_a_log_in_ranges_is_the_same_log(spark, folder):
    whole, ranged = derive.orders_log(spark, folder), derive.orders_log(spark, folder, ranges=5)
    assert ranged.exceptAll(whole).count() == whole.exceptAll(ranged).count() == 0
    place = F.struct(*commit_order())
    ends = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min(place).alias("a"), F.max(place).alias("b")).sort("p").collect()
    assert len(ends) == 5
    # a missing number comes first in Spark's order
    key = lambda r: [(v is not None, v or 0) for v in r]
    assert all(key(x["b"]) < key(y["a"]) for x, y in zip(ends, ends[1:]))


@pytest.mark.parametrize("name", ["stream_ingest", "stream_replay"])
def test_every_micro_batch_has_a_file_for_each_task(spark, folder, name, monkeypatch):
    seen, read = [], streams.source.stream_change_log

    def reading(spark, path, **options):
        seen.append((len(glob.glob(f"{path}/*.parquet")), options["max_files"]))
        return read(spark, path, **options)

    monkeypatch.setattr(streams.source, "stream_change_log", reading)
    assert getattr(streams, name)(spark, folder).count() > 0
    (files, taken), = seen
    tasks = spark.sparkContext.defaultParallelism
    assert taken >= tasks and files > 3 * taken


def test_sink_keeps_each_part_of_a_record_once(spark, folder, monkeypatch):
    seen, read = [], streams.sinks.read_batches
    monkeypatch.setattr(streams.sinks, "read_batches", lambda spark, path: seen.append(path) or read(spark, path))
    n = derive.orders_log(spark, folder).count()
    assert streams.stream_sink(spark, folder).count() == 5 * n
    held = read(spark, seen[0]).groupBy("event_ord").agg(*[F.count(c).alias(c) for c in ("fields", "keys", "new_data")]).collect()
    parts = derive.orders_log(spark, folder).agg(*[F.count(c).alias(c) for c in ("fields", "keys", "new_data")]).first()
    for c, at in (("fields", 3), ("keys", 4), ("new_data", 4)):
        assert {r["event_ord"]: r[c] for r in held} == {i: parts[c] if i == at else 0 for i in range(1, 6)}
