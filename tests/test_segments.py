import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from records import INSERT, b64, kv, meta

from tidemark.functions import size
from tidemark.operators import events, segments
from tidemark.schema import CHANGE_SCHEMA, ORDER

FIELDS = [{"name": "t", "meta": meta("TEXT")}]


def log(spark, n, seed, longest):
    rng = random.Random(seed)
    records = [{**INSERT, "fields": FIELDS, "new_data": [kv("t", b64("x" * rng.randrange(longest)))], "tx_seq": i, "scn": i * 10,
                "lsn": i, "check_point": f"{i}-1-{i * 10}"} for i in range(1, n + 1)]
    rng.shuffle(records)
    return spark.createDataFrame(records, CHANGE_SCHEMA)


def lengths(frame):
    found = events.sized_events(frame).collect()
    return [(r.tx_seq, r.event_ord, r.event_len) for r in sorted(found, key=lambda r: (r.tx_seq, r.event_ord))]


def rotate(items, limit, segment=1, position=size.SEGMENT_HEADER_BYTES):
    """The rotation rule, one item after the other."""
    for key, length in items:
        if position + length + size.SEGMENT_RESERVE_BYTES >= limit:
            segment, position = segment + 1, size.SEGMENT_HEADER_BYTES
        position += length
        yield key, segment, position


@pytest.mark.parametrize(("n", "longest", "limit", "buckets"), [
    (200, 50, 2_000, 8), (200, 50, 700, 3), (200, 900, 1_500, 8), (60, 50, 10_000_000, 8), (1, 5, 2_000, 2), (150, 1, 1_000, 8),
    (200, 50, 30_000, 16),
])
def test_greedy_segments(spark, n, longest, limit, buckets):
    frame = log(spark, n, n + longest, longest)
    got = segments.greedy_segments(frame, limit, buckets=buckets, fan=3).collect()
    expected = list(rotate((((tx, ord_), length) for tx, ord_, length in lengths(frame)), limit))
    assert {(r.tx_seq, r.event_ord): (r.segment_no, r.segment_pos) for r in got} == {k: (s, p) for k, s, p in expected}


def test_greedy_segments_resume(spark):
    frame = log(spark, 100, 5, 80)
    got = segments.greedy_segments(frame, 3_000, start_segment=9, start_position=2_345, buckets=5).collect()
    expected = rotate((((tx, ord_), length) for tx, ord_, length in lengths(frame)), 3_000, 9, 2_345)
    assert {(r.tx_seq, r.event_ord): (r.segment_no, r.segment_pos) for r in got} == {k: (s, p) for k, s, p in expected}


def test_whole_transactions(spark):
    frame = log(spark, 120, 6, 80)
    got = segments.greedy_segments(frame, 3_000, unit="txn", buckets=5)
    totals = {}
    for tx, _, length in lengths(frame):
        totals[tx] = totals.get(tx, 0) + length
    expected = {k: s for k, s, _ in rotate(sorted(totals.items()), 3_000)}
    rows = got.collect()
    assert len(rows) == 600 and all(expected[r.tx_seq] == r.segment_no for r in rows)
    last = {k: p for k, _, p in rotate(sorted(totals.items()), 3_000)}
    assert {r.tx_seq: r.segment_pos for r in rows if r.event_ord == 5} == last


def test_positions_and_quota(spark):
    frame = log(spark, 150, 7, 200)
    placed = segments.quota_segments(frame, 5_000, ("check_point",), buckets=6)
    rows = sorted(placed.collect(), key=lambda r: (r.tx_seq, r.event_ord))
    end = 0
    for r, (_, _, length) in zip(rows, lengths(frame)):
        end += length
        assert (r.event_len, r.end_pos, r.segment_no) == (length, end, (end - 1) // 5_000 + 1)
    summary = {r.segment_no: r for r in segments.segments_of(placed).collect()}
    assert sum(r.n_events for r in summary.values()) == 750 and sum(r.bytes for r in summary.values()) == end
    assert all(r.bytes <= 5_000 + 400 for r in summary.values())
    tail = summary[max(summary)]
    assert tail.check_point == "150-1-1500"


def test_segment_folders(spark, tmp_path):
    frame = log(spark, 100, 8, 200)
    placed = segments.quota_segments(frame, 5_000, buckets=4)
    path = str(tmp_path / "segments")
    segments.write_segments(placed, path)
    back = segments.read_segments(spark, path)
    columns = [*ORDER, "event_ord", "event_len", "end_pos", "segment_no"]
    assert sorted(map(tuple, back.select(columns).collect())) == sorted(map(tuple, placed.select(columns).collect()))
    pruned = back.filter(F.col("segment_no") == 2)._jdf.queryExecution().toString()
    assert "PartitionFilters" in pruned


def test_catalog_of_a_folder(spark, tmp_path):
    for name in ("ON.000001", "ON.000002", "ON.1", "ON.index", "XX.000003"):
        (tmp_path / name).write_bytes(b"12345")
    names = segments.segment_files(spark, str(tmp_path))
    assert {r.name: r.bytes for r in names.collect()}["ON.000002"] == 5
    assert {(r.segment_no, r["name"]) for r in segments.segment_catalog(names).collect()} == {(1, "ON.000001"), (2, "ON.000002")}


def test_status_and_chain(spark):
    found = spark.createDataFrame([(1, "31-1-54348795023361"), (2, "1-2"), (3, "1-2-")], "segment_no long, check_point string")
    names = spark.createDataFrame([(n,) for n in ("ON.000001", "ON.000002", "ON.3", "ON.9", "XX.1")], "name string")
    status = {r["name"]: (r.status, r.scn) for r in segments.segment_status(names, found).collect()}
    assert status["ON.000001"] == ("SUCCESS", 54348795023361) and status["ON.3"] == ("SUCCESS", 0)
    assert status["ON.000002"][0] == "INVALID_CHECKPOINT"
    assert status["ON.9"][0] == "FILE_NOT_EXIST" and status["XX.1"][0] == "INVALID_ARGUMENT"
    chain = {r.segment_no: (r.next_name, r.next_position, r.pointer_len) for r in segments.segment_chain(found).collect()}
    assert chain == {1: ("ON.000002", 4, 36), 2: ("ON.000003", 4, 36), 3: (None, None, None)}


def test_retention_and_resume(spark):
    found = spark.createDataFrame([(i,) for i in range(1, 11)], "segment_no long")
    assert {r.segment_no for r in segments.retention(found).collect() if not r.keep} == {1, 2, 3}
    assert {r.segment_no for r in segments.retention(found, 0.5, F.col("segment_no") > 4).collect() if not r.keep} == {5}
    empty = spark.createDataFrame([], "segment_no long, event_len long")
    assert tuple(segments.resume_point(empty).first()) == (1, 122)


def test_entries_of_many_runs_by_levels(spark):
    """Tables composed in levels of three give each run the entry it has in turn."""
    rng = random.Random(11)
    runs = [[rng.choice([20, 90, 400, 1_500]) for _ in range(rng.randrange(1, 30))] for _ in range(80)]
    limit, rows, expected = 2_000, [], []
    segment, position = 4, 700
    for part, lens in enumerate(runs):
        if part % 9 == 5:
            continue  # a bucket without rows
        expected.append((part, position, segment))
        *_, (_, segment, position) = rotate([(None, n) for n in lens], limit, segment, position)
        lowest, leave, opened, total = segments._first_cuts(np.array(lens), limit)
        rows += [(part, -(2**63), total, 0), *[(part, int(a), int(b), int(c)) for a, b, c in zip(lowest, leave, opened)]]
    tables = spark.createDataFrame(rows, segments._TABLE)
    got = segments.run_entries(tables, 80, 700, 4, fan=3)
    assert sorted(map(tuple, got.collect())) == expected
    assert "SinglePartition" not in got._jdf.queryExecution().toString()


def test_retention_places_events_once(spark):
    """The segments and their first and last number come out of one pass over the events."""
    placed = segments.quota_segments(log(spark, 90, 7, 60), 1_000, buckets=4).select("segment_no").distinct()
    kept = segments.retention(placed)
    found = {r.segment_no: r.keep for r in kept.collect()}
    assert found == {n: n > int(len(found) * 0.3) for n in range(1, len(found) + 1)} and len(found) > 9
    plan = kept._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("== Initial Plan ==")]
    assert final.count("ReusedExchange") == 2  # the placed records for their buckets' starts, and the segments


def test_tabulating_takes_sizes_alone(spark):
    """The pass that only needs sizes sends nothing else to Python, and still shares its shuffle with the one that cuts."""
    placed = segments.greedy_segments(log(spark, 80, 3, 60), 1_500, keep=("check_point",), buckets=4)
    expected = rotate((((tx, ord_), length) for tx, ord_, length in lengths(log(spark, 80, 3, 60))), 1_500)
    assert {(r.tx_seq, r.event_ord): (r.segment_no, r.segment_pos) for r in placed.collect()} == {k: (s, p) for k, s, p in expected}
    plan = placed._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("== Initial Plan ==")]
    taken = [line for line in final.splitlines() if "tabulate(" in line]
    assert taken and not any("check_point" in line for line in taken)
    assert final.count("ReusedExchange") == 1
