import json

import pytest
from pyspark.sql import functions as F
from test_segments import lengths, log, rotate

from tidemark.operators import rotation, segments


def placed(frame):
    return sorted((r.tx_seq, r.event_ord, r.segment_no, r.segment_pos) for r in frame.collect())


@pytest.fixture(scope="module")
def whole(spark):
    return log(spark, 120, 5, 60).cache()


def test_stop_and_resume_write_the_segments_of_one_run(spark, whole, tmp_path):
    path = str(tmp_path / "out")
    for stop in (1, 40, 40, 90, 120):  # the third run has nothing new
        seen = whole.filter(F.col("tx_seq") <= stop)
        state = rotation.append_segments(rotation.not_yet_written(seen, rotation.rotation_state(spark, path)), path, 3_000, buckets=3)
        assert state.tx_seq == stop
    wanted = sorted((key[0], key[1], no, pos) for key, no, pos in rotate([((t, o), n) for t, o, n in lengths(whole)], 3_000))
    events = rotation.read_rotation(spark, path)
    assert placed(events) == wanted
    assert (state.segment_no, state.position) == wanted[-1][2:] and state.check_point == "120-1-1200"
    assert [r.n_events > 0 for r in rotation.rotation_commits(spark, path).sort("run").collect()] == [True, True, False, True, True]
    # the segments of the runs are read like those of one
    numbers = sorted({w[2] for w in wanted})
    assert [r.segment_no for r in segments.segment_chain(events).sort("segment_no").collect()] == numbers
    summed = segments.segments_of(events)
    names = segments.segment_index(summed).select("name")
    assert {r.status for r in segments.segment_status(names, summed).collect()} == {segments.OK}


def test_failed_and_repeated_runs(spark, whole, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    rotation.append_segments(whole.filter("tx_seq <= 30"), path, 3_000, run=0)
    with monkeypatch.context() as broken:
        broken.setattr(rotation, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            rotation.append_segments(whole.filter("tx_seq > 30"), path, 3_000, run=1)
    assert {r.tx_seq for r in rotation.read_rotation(spark, path).collect()} == set(range(1, 31))
    rotation.append_segments(whole.filter("tx_seq > 30 AND tx_seq <= 60"), path, 3_000, run=1)
    rotation.append_segments(whole.filter("tx_seq > 30"), path, 3_000, run=1)  # a repeated batch
    events = rotation.read_rotation(spark, path)
    assert placed(events) == placed(segments.greedy_segments(whole.filter("tx_seq <= 60"), 3_000, keep=("check_point",)))


def test_empty_runs(spark, whole, tmp_path):
    path = str(tmp_path / "out")
    assert rotation.rotation_state(spark, path) is None
    state = rotation.append_segments(whole.limit(0), path, 3_000)
    assert (state.run, state.segment_no, state.n_events, state.scn) == (0, 1, 0, None)
    with pytest.raises(ValueError):
        rotation.read_rotation(spark, path)
    rotation.append_segments(whole, path, 3_000)
    assert placed(rotation.read_rotation(spark, path)) == placed(segments.greedy_segments(whole, 3_000))


def test_micro_batches(spark, whole, tmp_path):
    path, source = str(tmp_path / "out"), tmp_path / "in"
    for i, (low, high) in enumerate([(0, 50), (50, 80), (80, 120)]):
        whole.filter(f"tx_seq > {low} AND tx_seq <= {high}").coalesce(1).write.json(str(source / f"{i}"))
        stream = spark.readStream.schema(whole.schema).json(str(source / "*"))
        query = rotation.rotating_writer(stream, path, limit=3_000).option(
            "checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        query.awaitTermination()
    commits = [json.loads(f.read_text()) for f in sorted((tmp_path / "out" / "commits").glob("run-*.json"))]
    assert [c["tx_seq"] for c in commits] == [50, 80, 120]
    assert placed(rotation.read_rotation(spark, path)) == placed(segments.greedy_segments(whole, 3_000))
