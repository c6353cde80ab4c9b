"""A sink of segments that carries its rotation over runs and micro-batches.

Events of a run go to a folder of the run, split by segment. Then one small file commits the run with where it left the
rotation: the open segment, the position in it, the checkpoint and the place of the last record. The next run enters
there, so a log written in any number of runs has the segments of a single one, and a segment may have a part in
several runs. What is read are the folders of committed runs alone: a run that failed leaves nothing visible, and its
folder is written anew. A run that is committed already is not written again, which makes repeated micro-batches harmless.

One writer at a time. Runs come in commit order; a record that comes late is appended where the rotation is by then.
A run without records is committed and changes nothing. Records that share the whole commit order of the last record
of a run count as written by it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemark.functions import size
from tidemark.operators.segments import greedy_segments, write_segments
from tidemark.schema import ORDER, commit_order
from tidemark.sources.change_log import after_checkpoint

_COMMIT = ("run long, segment_no long, position long, check_point string, n_events long, "
           "scn long, tx_seq long, seq long, lsn long, dn int")


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def rotation_commits(spark: SparkSession, path: str) -> DataFrame:
    """One row for each committed run: where it left the rotation, and how many events it wrote."""
    files, folder = _hadoop(spark, f"{path}/commits")
    if not files.exists(folder):
        return spark.createDataFrame([], _COMMIT)
    return spark.read.schema(_COMMIT).json(f"{path}/commits")


def rotation_state(spark: SparkSession, path: str) -> Row | None:
    """Where the last committed run left the rotation; None before the first."""
    return rotation_commits(spark, path).orderBy(F.desc("run")).first()


def not_yet_written(log: DataFrame, state: Row | None) -> DataFrame:
    """The records of a whole log that no committed run holds."""
    if state is None or state["scn"] is None:
        return log
    return after_checkpoint(log, *[state[c] for c in ORDER])


def _commit(spark: SparkSession, path: str, state: dict) -> None:
    """Make a run visible: its file appears under its name whole or not at all."""
    files, hidden = _hadoop(spark, f"{path}/commits/.run-{state['run']:012d}")
    _, shown = _hadoop(spark, f"{path}/commits/run-{state['run']:012d}.json")
    out = files.create(hidden, True)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    if files.exists(shown) or not files.rename(hidden, shown):
        raise RuntimeError(f"run {state['run']} of {path} was committed by another writer")


def append_segments(records: DataFrame, path: str, limit: int = size.SEGMENT_LIMIT_BYTES, unit: str = "event",
                    keep: Sequence[str] = (), run: int | None = None, buckets: int | None = None) -> Row:
    """Write ``records`` behind what ``path`` holds, and return where that leaves the rotation.

    ``run`` numbers rise; without one the run follows the last. A number up to the last one was committed before.
    """
    spark = records.sparkSession
    before = rotation_state(spark, path)
    if run is None:
        run = before["run"] + 1 if before else 0
    if before and run <= before["run"]:
        return before
    segment, position = (before["segment_no"], before["position"]) if before else (1, size.SEGMENT_HEADER_BYTES)
    placed = greedy_segments(records, limit, unit, tuple(dict.fromkeys(["check_point", *keep])), segment, position, buckets)
    folder = f"{path}/runs/run={run}"
    write_segments(placed, folder, mode="overwrite")
    written = _run_events(spark, [folder], placed.schema)
    place = F.struct(*commit_order(), F.col("event_ord"))
    last = written.agg(
        F.count(F.lit(1)).alias("n_events"), F.max(F.struct("segment_no", "segment_pos")).alias("left"),
        F.max_by(F.struct("check_point", *ORDER), place).alias("last")).first()
    state = {"run": run, "segment_no": segment, "position": position, "n_events": last["n_events"],
             **{c: before[c] if before else None for c in ("check_point", *ORDER)}}
    if last["n_events"]:
        own = last["last"].asDict()
        # a late record does not take the place back
        if before and before["scn"] is not None and _place(before.asDict()) > _place(own):
            own = {c: before[c] for c in ORDER} | {"check_point": own["check_point"]}
        state |= {"segment_no": last["left"]["segment_no"], "position": last["left"]["segment_pos"], **own}
    _commit(spark, path, state)
    return rotation_state(spark, path)


def _place(record: dict) -> tuple:
    """A commit place that compares as Spark orders it: NULL first, and no source node before any."""
    return tuple((record[c] is not None, record[c] or 0) for c in ORDER)


def _run_events(spark: SparkSession, folders: list[str], schema: T.StructType) -> DataFrame:
    """Events of some runs; a run without events has an empty folder."""
    plain = [f for f in schema.fields if f.name != "segment_no"]
    stored = T.StructType([*plain, T.StructField("segment_block", T.LongType()), T.StructField("segment_no", T.LongType())])
    parts = spark.read.schema(stored).option("basePath", folders[0].rsplit("/", 1)[0]).parquet(*folders)
    return parts.select(*schema.names)


def read_rotation(spark: SparkSession, path: str) -> DataFrame:
    """All events of the committed runs; filters on ``segment_no`` prune folders."""
    runs = [r["run"] for r in rotation_commits(spark, path).filter("n_events > 0").select("run").sort("run").collect()]
    if not runs:
        raise ValueError(f"{path} holds no events yet")
    folders = [f"{path}/runs/run={n}" for n in runs]
    first = spark.read.parquet(folders[0]).drop("segment_block").withColumn("segment_no", F.col("segment_no").cast("long"))
    return _run_events(spark, folders, first.schema)


def rotating_writer(stream: DataFrame, path: str, **rotation) -> DataStreamWriter:
    """Append every micro-batch of a stream of records; see ``append_segments``."""
    return stream.writeStream.foreachBatch(
        lambda batch, batch_id: append_segments(batch, path, run=batch_id, **rotation) and None)
