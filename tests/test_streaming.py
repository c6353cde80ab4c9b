import random

from pyspark.sql import functions as F
from records import INSERT
from test_replay import BASE, KEY, SPEC, random_log, record, sequential

from tidemark.operators import events
from tidemark.schema import CHANGE_SCHEMA
from tidemark.sources.change_log import after_checkpoint, contradicting, deduplicate, last_record, write_change_log
from tidemark.streaming import sinks, source


def land(spark, path, records, files):
    """Write records as separate files, one append each."""
    size = -(-len(records) // files)
    for at in range(0, len(records), size):
        write_change_log(spark.createDataFrame(records[at:at + size], CHANGE_SCHEMA).coalesce(1), path)


def drain(writer, folder):
    query = source.start(writer, f"{folder}/checkpoint", drain=True)
    query.awaitTermination()
    return query


def test_replay_of_late_and_repeated_records(spark, tmp_path):
    records = random_log(300, 30, 5)
    mixed = records[:]
    random.Random(2).shuffle(mixed)
    folder = str(tmp_path)
    land(spark, f"{folder}/log", mixed + mixed[:40], 3)
    stream = source.stream_change_log(spark, f"{folder}/log", max_files=1)
    drain(sinks.replay_writer(stream, f"{folder}/states", SPEC, KEY), folder)
    base = spark.createDataFrame([(k, a, b) for k, (a, b) in BASE.items()], "id long, a long, b string")
    expected = sequential(records, BASE)[0]
    assert {r.id: (r.a, r.b) for r in sinks.read_table(spark, f"{folder}/states", base, KEY).collect()} == expected
    sinks.compact_states(spark, f"{folder}/states", f"{folder}/compact", KEY)
    assert {r.id: (r.a, r.b) for r in sinks.read_table(spark, f"{folder}/compact", base, KEY).collect()} == expected


def test_a_batch_that_is_seen_again_is_written_once(spark, tmp_path):
    folder = str(tmp_path)
    records = [record(i, "I", None, {"id": i, "a": i, "b": "x"}) for i in range(1, 21)]
    land(spark, f"{folder}/log", records, 2)
    stream = source.stream_change_log(spark, f"{folder}/log", max_files=1)
    writer = sinks.ordered_writer(stream, f"{folder}/out", events.dml_events)
    drain(writer, folder)
    # a second run from scratch sees the same batches again
    drain(sinks.ordered_writer(source.stream_change_log(spark, f"{folder}/log", max_files=1), f"{folder}/out",
                               events.dml_events), f"{folder}/again")
    out = sinks.read_batches(spark, f"{folder}/out")
    assert out.count() == 100 and out.select("tx_seq", "event_ord").distinct().count() == 100
    # a restart from the first checkpoint takes in only what is new
    land(spark, f"{folder}/log", [record(99, "I", None, {"id": 99, "a": 1, "b": "y"})], 1)
    drain(sinks.ordered_writer(source.stream_change_log(spark, f"{folder}/log"), f"{folder}/out", events.dml_events), folder)
    out = sinks.read_batches(spark, f"{folder}/out")
    assert out.count() == 105 and {r.tx_seq for r in out.filter("batch_id = 2").collect()} == {99}


def test_batches_are_in_commit_order(spark, tmp_path):
    records = [record(i, "I", None, {"id": i, "a": i, "b": "x"}) for i in range(1, 201)]
    random.Random(3).shuffle(records)
    land(spark, f"{tmp_path}/log", records, 1)
    stream = source.stream_change_log(spark, f"{tmp_path}/log")
    drain(sinks.ordered_writer(stream, f"{tmp_path}/out"), str(tmp_path))
    rows = spark.read.parquet(f"{tmp_path}/out").select("tx_seq", F.input_file_name().alias("f")).collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r.f, []).append(r.tx_seq)
    ordered = [by_file[f] for f in sorted(by_file)]
    assert [tx for part in ordered for tx in part] == list(range(1, 201))


def test_progress(spark, tmp_path):
    land(spark, f"{tmp_path}/log", [record(i, "I", None, {"id": i}) for i in range(1, 8)], 1)
    stream = source.with_progress(source.stream_change_log(spark, f"{tmp_path}/log"))
    query = drain(sinks.batch_writer(stream, f"{tmp_path}/out"), str(tmp_path))
    seen = [p["observedMetrics"]["progress"] for p in query.recentProgress if p["numInputRows"]]
    assert (seen[0]["n_records"], seen[0]["n_events"], seen[0]["last_tx"]) == (7, 35, 7)


def test_duplicates_within_the_watermark(spark, tmp_path):
    records = [record(i, "I", None, {"id": i}) for i in range(1, 31)]
    land(spark, f"{tmp_path}/log", records + records[:10], 2)
    stream = source.stream_change_log(spark, f"{tmp_path}/log", max_files=1)
    out = source.deduplicated(stream).select("tx_seq").writeStream.format("parquet").option("path", f"{tmp_path}/out")
    drain(out, str(tmp_path))
    assert sorted(r.tx_seq for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(1, 31))


def test_batch_helpers(spark):
    log = spark.createDataFrame([record(i, "I", None, {"id": i}) for i in (3, 1, 2, 2)] + [INSERT], CHANGE_SCHEMA)
    assert sorted(r.tx_seq for r in deduplicate(log).collect()) == [1, 2, 3, 38]
    assert last_record(log).first().tx_seq == 38
    assert sorted(r.tx_seq for r in after_checkpoint(log, 2, 2, 1).collect()) == [3, 38]
    assert sorted(r.tx_seq for r in after_checkpoint(log, 2, 2, 0).collect()) == [2, 2, 3, 38]
    assert sorted(r.tx_seq for r in after_checkpoint(log, 2, 2).collect()) == [2, 2, 3, 38]


def test_resuming_between_ties_loses_nothing(spark):
    rows = [(5, 1, 0, lsn, dn) for lsn in (1, 2, 3) for dn in (None, 0, 1)] + [(5, 1, 1, 1, 0), (6, 1, 0, 1, 0), (4, 9, 9, 9, 9)]
    log = spark.createDataFrame(rows, "scn long, tx_seq long, seq long, lsn long, dn short")
    place = lambda r: tuple(r[:4]) + (-1 if r[4] is None else r[4],)
    for cut in rows:
        at = place(cut)
        got = sorted(map(place, after_checkpoint(log, *at).collect()))
        assert got == sorted(p for p in map(place, rows) if p > at)


def test_one_of_two_records_at_a_position_stays_at_every_run(spark):
    rows = [(1, 1, 1, 1, 0, op) for op in ("I", "U", "I")] + [(1, 1, 1, 2, 0, "D")] * 2
    log = spark.createDataFrame(rows, "scn long, tx_seq long, seq long, lsn long, dn short, op_type string")
    picks = {tuple(sorted(r.op_type for r in deduplicate(log.repartition(n)).collect())) for n in (1, 2, 5)}
    assert len(picks) == 1 and len(picks.pop()) == 2
    assert [(r.lsn, r.n) for r in contradicting(log).collect()] == [(1, 3)]
