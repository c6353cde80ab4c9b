"""Size-bounded numbered segments of a log: assignment, catalog, status, chain and retention."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numeric import whole_div
from tidemark.functions import ids, size
from tidemark.operators.events import _event_columns, event_sizes, explode_ends, log_positions
from tidemark.operators.scans import add_buckets, bucket_count, numbered
from tidemark.schema import ORDER, commit_order

# Fixed values
BATCH_RECORDS = 4096
ROTATE_POSITION = 4
BLOCK_SEGMENTS = 1_000
RETENTION_SHARE = 0.3

# Status of a segment lookup
OK = "SUCCESS"
BAD_NAME = "INVALID_ARGUMENT"
NOT_FOUND = "FILE_NOT_EXIST"
BAD_CHECKPOINT = "INVALID_CHECKPOINT"


def batch_numbers(log: DataFrame, batch: int = BATCH_RECORDS, buckets: int | None = None) -> DataFrame:
    """Add ``batch_no`` (from 0): groups of ``batch`` records in commit order."""
    placed = numbered(log, commit_order(), "pos", buckets)
    return placed.withColumn("batch_no", whole_div(F.col("pos") - 1, batch))


def quota_segments(log: DataFrame, quota: int = size.SEGMENT_LIMIT_BYTES, keep: Sequence[str] = (),
                   buckets: int | None = None) -> DataFrame:
    """Events with ``segment_no`` (from 1) by their end position: a segment holds at most ``quota`` bytes plus
    the part of its first event that began before it."""
    placed = log_positions(log, keep, buckets)
    return placed.withColumn("segment_no", whole_div(F.col("end_pos") - 1, quota) + 1)


def _first_cuts(lens: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """How a run of events leaves a segment, for every position at which the run may be entered.

    Returns, by the event that opens the first new segment: the lowest entry position for which it does, the
    position at the end of the run, and the number of segments opened; and the bytes of the run.
    """
    n = len(lens)
    through = np.cumsum(lens)
    before = through - lens
    room = limit - size.SEGMENT_RESERVE_BYTES
    nxt = np.maximum(np.searchsorted(through, before + (room - size.SEGMENT_HEADER_BYTES)), np.arange(1, n + 1))
    # follow the chain of openings to its end by doubling
    step = np.where(nxt < n, nxt, np.arange(n))
    opened = (nxt < n).astype(np.int64)
    while True:
        further = step[step]
        if np.array_equal(further, step):
            break
        opened = opened + opened[step]
        step = further
    reach = min(int(np.searchsorted(through, room - size.SEGMENT_HEADER_BYTES)), n - 1)
    first = np.arange(reach + 1)
    lowest = room - through[first]
    leave = size.SEGMENT_HEADER_BYTES + through[-1] - before[step[first]]
    return lowest, leave, opened[first] + 1, int(through[-1])


#: Rows of a table of a run: from entry position ``low`` on, the run leaves at ``leave`` and opens ``opened`` segments.
#: The row without a lower bound opens none; its ``leave`` is the length of the run.
_TABLE = "_part long, low long, leave long, opened long"
_ENTRY = "_part long, _entry_pos long, _entry_segment long"
_NO_BOUND = np.iinfo(np.int64).min
FAN = 256


def _coalesced(low: np.ndarray, leave: np.ndarray, opened: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours that leave alike as one row; rows come by ascending bound, the first without one."""
    new = np.append(True, (leave[1:] != leave[:-1]) | (opened[1:] != opened[:-1]) | (opened[1:] == 0))
    return low[new], leave[new], opened[new]


def _composed(first: tuple, then: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The table of two runs in turn."""
    (low1, leave1, opened1), (low2, leave2, opened2) = first, then
    length = leave1[0]
    # entered so that the first run opens nothing, the second is entered further on by its length
    shifted = low2[1:] - length
    kept = shifted < low1[1] if len(low1) > 1 else np.ones(len(shifted), bool)
    # otherwise it is entered where the first one leaves
    at = np.searchsorted(low2, leave1[1:], side="right") - 1
    stays = opened2[at] == 0
    return _coalesced(
        np.concatenate([low1[:1], shifted[kept], low1[1:]]),
        np.concatenate([[length + leave2[0]], leave2[1:][kept], np.where(stays, leave1[1:] + leave2[at], leave2[at])]),
        np.concatenate([[0], opened2[1:][kept], opened1[1:] + opened2[at]]))


def _tables(rows: pd.DataFrame) -> list[tuple[int, tuple]]:
    """The tables of a group of runs, in order."""
    rows = rows.sort_values(["_part", "low"])
    return [(int(part), tuple(own[c].to_numpy(np.int64) for c in ("low", "leave", "opened"))) for part, own in rows.groupby("_part", sort=True)]


def _compose_group(rows: pd.DataFrame) -> pd.DataFrame:
    low, leave, opened = reduce(_composed, [table for _, table in _tables(rows)])
    return pd.DataFrame({"_part": rows["_group"].iloc[0], "low": low, "leave": leave, "opened": opened})


def _enter_group(rows: pd.DataFrame) -> pd.DataFrame:
    """Where each run of a group is entered, from where the group is."""
    position, segment, found = int(rows["_entry_pos"].iloc[0]), int(rows["_entry_segment"].iloc[0]), []
    for part, (low, leave, opened) in _tables(rows):
        found.append((part, position, segment))
        at = int(np.searchsorted(low, position, side="right")) - 1
        position = int(leave[at]) if opened[at] else position + int(leave[at])
        segment += int(opened[at])
    return pd.DataFrame(found, columns=["_part", "_entry_pos", "_entry_segment"])


def run_entries(tables: DataFrame, n_runs: int, position: int, segment: int, fan: int = FAN) -> DataFrame:
    """The position and segment at which each of at most ``n_runs`` runs is entered.

    Tables of ``fan`` neighbours are composed into one, level by level, until ``fan`` are left; entries are then handed
    down the same levels. No task holds more than ``fan`` tables.
    """
    group = F.floor(F.col("_part") / fan).alias("_group")
    levels = [tables]
    while n_runs > fan:
        n_runs = -(-n_runs // fan)
        levels.append(levels[-1].select("*", group).groupBy("_group").applyInPandas(_compose_group, _TABLE))
    entries = tables.sparkSession.createDataFrame([(0, position, segment)], _ENTRY)
    for own in reversed(levels):
        known = entries.withColumnRenamed("_part", "_group")
        # one row for each group
        entries = own.select("*", group).join(known, "_group").groupBy("_group").applyInPandas(_enter_group, _ENTRY)
    return entries


def greedy_segments(
    log: DataFrame,
    limit: int = size.SEGMENT_LIMIT_BYTES,
    unit: str = "event",
    keep: Sequence[str] = (),
    start_segment: int = 1,
    start_position: int = size.SEGMENT_HEADER_BYTES,
    buckets: int | None = None,
    fan: int = FAN,
) -> DataFrame:
    """Events with ``segment_no`` and ``segment_pos`` (end position in the segment) under the rotation rule:
    an event opens a new segment when ``position + length + reserve >= limit``.

    The rule is sequential, yet where a run of the log leaves a segment depends only on the position at which it is
    entered. Each bucket of the commit order tabulates that (at most one row per event of its first segment); the tables
    are composed in levels, which gives the true entry of every bucket; the buckets are then cut independently.
    ``unit='txn'`` keeps the events of a record together.
    """
    if unit not in ("event", "txn"):
        raise ValueError("unit is 'event' or 'txn'")
    columns = list(dict.fromkeys([*ORDER, *keep]))
    ranged = add_buckets(event_sizes(log).select(*columns, "ends"), commit_order(), buckets, "_part")
    ranged = ranged.repartition("_part")  # both passes read all columns, so that they share one shuffle
    in_turn = ["_part", *commit_order(), "ends"]  # records of one place are told apart by their sizes
    room = limit - size.SEGMENT_RESERVE_BYTES

    def lengths(ends: pa.ListArray) -> np.ndarray:
        """Of events, or of records."""
        flat, stops = ends.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(ends.value_lengths().to_numpy())
        if unit == "txn":
            return flat[stops - 1]
        out = np.diff(flat, prepend=0)
        out[stops[:-1]] = flat[stops[:-1]]
        return out

    def tabulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(part: int, pieces: list[np.ndarray]) -> pa.RecordBatch:
            lowest, leave, opened, total = _first_cuts(np.concatenate(pieces), limit)
            low, leave, opened = _coalesced(np.append(_NO_BOUND, lowest[::-1]), np.append(total, leave[::-1]), np.append(0, opened[::-1]))
            return pa.RecordBatch.from_pydict({"_part": np.full(len(low), part, np.int64), "low": low, "leave": leave, "opened": opened})

        part, pieces = None, []
        for batch in batches:
            for own, rows in _runs(batch):
                if own != part and pieces:
                    yield table(part, pieces)
                    pieces = []
                part = own
                pieces.append(lengths(rows.column("ends")))
        if pieces:
            yield table(part, pieces)

    # Python needs the sizes alone; a hash stands for the other columns, for without them the shuffle would be another one
    sized = ranged.sortWithinPartitions(*in_turn).select("_part", "ends", F.xxhash64(*columns).alias("_every"))
    tables = sized.mapInArrow(tabulate, _TABLE)
    entries = run_entries(tables, bucket_count(log, buckets) + 1, start_position, start_segment, fan)
    known = entries.withColumnRenamed("_part", "_entry_part")
    # one row per bucket
    entered = ranged.join(F.broadcast(known), F.col("_part").eqNullSafe(F.col("_entry_part"))).drop("_entry_part")
    schema = T.StructType([f for f in entered.schema.fields if f.name in (*columns, "ends")]
                          + [T.StructField(c, T.ArrayType(T.LongType())) for c in ("_segments", "_positions")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = position = segment = None
        for batch in batches:
            for own, rows in _runs(batch):
                if own != part:
                    part, position, segment = own, rows.column("_entry_pos")[0].as_py(), rows.column("_entry_segment")[0].as_py()
                through = np.cumsum(lengths(rows.column("ends")))
                numbers = np.empty(len(through), np.int64)
                ends = np.empty(len(through), np.int64)
                at, gone = 0, 0
                while at < len(through):
                    stop = int(np.searchsorted(through, room - position + gone))
                    if stop <= at:
                        segment, position, stop = segment + 1, size.SEGMENT_HEADER_BYTES, at + 1
                        stop = max(stop, int(np.searchsorted(through, room - position + gone)))
                    numbers[at:stop] = segment
                    ends[at:stop] = position + through[at:stop] - gone
                    position, gone, at = int(ends[stop - 1]), int(through[stop - 1]), stop
                each = rows.column("ends").value_lengths().to_numpy() if unit == "event" else np.ones(rows.num_rows, np.int64)
                offsets = pa.array(np.append(0, np.cumsum(each)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(c) for c in schema.names[:-2]] + [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (numbers, ends)],
                    names=schema.names)

    placed = entered.sortWithinPartitions(*in_turn).mapInArrow(cut, schema).select(*columns, "ends", "_segments", "_positions", explode_ends())
    ordinal = F.col("event_ord")
    if unit == "event":
        place = [F.element_at("_segments", ordinal).alias("segment_no"), F.element_at("_positions", ordinal).alias("segment_pos")]
    else:
        opens = F.get("_positions", F.lit(0)) - F.element_at("ends", -1)
        place = [F.get("_segments", F.lit(0)).alias("segment_no"), (opens + F.element_at("ends", ordinal)).alias("segment_pos")]
    return placed.select(*columns, *_event_columns(), *place)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of each bucket of a batch that is sorted by bucket."""
    parts = batch.column("_part").to_numpy(zero_copy_only=False)
    edges = np.append(np.flatnonzero(np.append(True, parts[1:] != parts[:-1])), len(parts)) if len(parts) else []
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(parts[a]), batch.slice(a, b - a)


def segments_of(events: DataFrame, order: Column | None = None) -> DataFrame:
    """One row per segment: events, bytes, first and last transaction, checkpoint of its last record."""
    place = order if order is not None else F.struct(*commit_order(), F.col("event_ord"))
    return events.groupBy("segment_no").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum("event_len").alias("bytes"),
        F.min("tx_seq").alias("first_tx"),
        F.max("tx_seq").alias("last_tx"),
        F.max_by("check_point", place).alias("check_point"),
    )


def segment_index(segments: DataFrame, prefix: str = ids.SEGMENT_PREFIX) -> DataFrame:
    """Segment names by number."""
    return segments.select("segment_no").distinct().select(
        "segment_no", ids.segment_name(F.col("segment_no"), prefix).alias("name"))


def segment_chain(segments: DataFrame, prefix: str = ids.SEGMENT_PREFIX) -> DataFrame:
    """Each segment with the pointer to the next (NULL for the open one) and the size of that pointer.

    Segments are numbered without gaps, so the next one is known from the last alone.
    """
    known = segments.select("segment_no").distinct()
    last = F.broadcast(segments.agg(F.max("segment_no").alias("last_no")))  # one row
    following = F.when(F.col("segment_no") < F.col("last_no"), F.col("segment_no") + 1)
    return known.join(last).withColumn("next_no", following).select(
        "segment_no",
        ids.segment_name(F.col("segment_no"), prefix).alias("name"),
        F.when(F.col("next_no").isNotNull(), ids.segment_name(F.col("next_no"), prefix)).alias("next_name"),
    ).withColumns({
        "next_position": F.when(F.col("next_name").isNotNull(), ROTATE_POSITION),
        "pointer_len": F.when(F.col("next_name").isNotNull(), size.rotate_bytes(F.col("next_name"))),
    })


def segment_catalog(names: DataFrame, prefix: str = ids.SEGMENT_PREFIX) -> DataFrame:
    """Valid segment names by number; of several names with one number the first in name order stays."""
    number = ids.segment_number(F.col("name"), prefix)
    return names.select("name", number.alias("segment_no")).filter(F.col("segment_no").isNotNull()).groupBy(
        "segment_no").agg(F.min("name").alias("name"))


def segment_files(spark: SparkSession, path: str) -> DataFrame:
    """Names and bytes of the files in a segment folder (file contents are not read)."""
    listed = spark.read.format("binaryFile").load(path).select("path", "length")
    return listed.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"))


def segment_status(names: DataFrame, segments: DataFrame, prefix: str = ids.SEGMENT_PREFIX) -> DataFrame:
    """Where each named segment stopped, or why that is not known."""
    asked = names.select("name", ids.segment_number(F.col("name"), prefix).alias("segment_no"))
    known = segments.select("segment_no", "check_point", F.lit(True).alias("_known"))
    # bad names have no number to join on and would all meet in one task
    found = asked.filter(F.col("segment_no").isNotNull()).join(known, "segment_no", "left").unionByName(
        asked.filter(F.col("segment_no").isNull()), allowMissingColumns=True)
    parsed = found.withColumn("_c", ids.parse_checkpoint(F.col("check_point")))
    status = (F.when(F.col("segment_no").isNull(), BAD_NAME).when(F.col("_known").isNull(), NOT_FOUND)
              .when(F.col("_c").isNull(), BAD_CHECKPOINT).otherwise(OK))
    return parsed.select("name", status.alias("status"), F.col("_c.tx_seq").alias("tx_seq"),
                         F.col("_c.seq").alias("seq"), F.col("_c.scn").alias("scn"))


def resume_point(events: DataFrame) -> DataFrame:
    """The last segment and the bytes it holds (header included); the first, empty one for an empty log."""
    last = events.groupBy("segment_no").agg(F.sum("event_len").alias("bytes")).agg(
        F.max(F.struct("segment_no", "bytes")).alias("s"))
    return last.select(
        F.coalesce("s.segment_no", F.lit(1).cast("long")).alias("last_segment"),
        (F.coalesce("s.bytes", F.lit(0)) + size.SEGMENT_HEADER_BYTES).cast("long").alias("used_bytes"))


def retention(segments: DataFrame, share: float = RETENTION_SHARE, before: Column | None = None) -> DataFrame:
    """Add ``keep``: false for the oldest ``share`` of the segments (of those for which ``before`` holds).

    Segments are one row each and numbered without gaps, so age is a comparison with the first and last number.
    """
    # The count, which any row passes, needs each segment once: for the least and greatest number alone, a ``distinct`` that
    # made the segments would be left out here, and all events placed anew instead of the segments read twice
    ends = F.broadcast(segments.agg(F.min("segment_no").alias("_low"), F.max("segment_no").alias("_high"), F.count(F.lit(1)).alias("_n"))
                       .filter(F.col("_n") >= 0).drop("_n"))  # one row
    oldest = F.floor((F.col("_high") - F.col("_low") + 1) * F.lit(share))
    drop = F.col("segment_no") - F.col("_low") < oldest
    if before is not None:
        drop = drop & before
    return segments.join(ends).withColumn("keep", ~F.coalesce(drop, F.lit(False))).drop("_low", "_high")


def write_segments(events: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write events to one folder per segment, a thousand segments to a folder of their own. Segments are ranges of
    the log, and so are the partitions of ``events``: no shuffle is needed and a segment gets one file per range that
    touches it."""
    block = F.floor(F.col("segment_no") / BLOCK_SEGMENTS).alias("segment_block")
    events.select("*", block).write.partitionBy("segment_block", "segment_no").mode(mode).parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """All events of a segment folder; filters on ``segment_no`` prune folders."""
    return spark.read.parquet(path).withColumn("segment_no", F.col("segment_no").cast("long")).drop("segment_block")


def read_segment_range(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Events of segments ``first`` to ``last``; only the folders of their blocks are listed."""
    blocks = [f"{path}/segment_block={b}" for b in range(first // BLOCK_SEGMENTS, last // BLOCK_SEGMENTS + 1)]
    return spark.read.option("basePath", path).parquet(*blocks).withColumn(
        "segment_no", F.col("segment_no").cast("long")).drop("segment_block").filter(F.col("segment_no").between(first, last))
