"""Sinks that may see a micro-batch again and still write it once.

Every batch has its own folder, named by the batch id and written in overwrite mode: a batch that is retried after a
failure replaces what its first attempt left.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.functions.types import Field
from tidemark.operators import replay
from tidemark.schema import commit_order
from tidemark.session import shuffle_width


def batch_writer(stream: DataFrame, path: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataStreamWriter:
    """Write each transformed micro-batch to its own folder of ``path``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(write)


def ordered_writer(stream: DataFrame, path: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataStreamWriter:
    """``batch_writer`` with the records of a batch put into commit order first (a range shuffle)."""

    def in_order(batch: DataFrame) -> DataFrame:
        order = commit_order()
        return transform(batch.repartitionByRange(shuffle_width(batch), *order).sortWithinPartitions(*order))

    return batch_writer(stream, path, in_order)


def replay_writer(stream: DataFrame, path: str, fields: Sequence[Field], key: Sequence[str]) -> DataStreamWriter:
    """Write the key states of each micro-batch.

    A batch costs what its own changes cost: the table is not read or rewritten. States merge in any order, so
    records that arrive in a later batch than their commit order asks for still end up right.
    """
    return batch_writer(stream, path, lambda batch: replay.key_states(replay.row_changes(batch, fields, key), key))


def read_states(spark: SparkSession, path: str, key: Sequence[str]) -> DataFrame:
    """The merged key states of all batches."""
    return replay.merge_states(spark.read.parquet(path).drop("batch_id"), key)


def read_table(spark: SparkSession, path: str, base: DataFrame, key: Sequence[str], ended: DataFrame | None = None) -> DataFrame:
    """The table as of the batches written so far; ``ended`` (see ``replay.settle``) says when a definition last emptied
    it, in whatever batch its records and that definition came."""
    if ended is not None:
        base = base.join(F.broadcast(ended.select("at")), F.col("at").isNull()).drop("at")  # one row
    return replay.apply_net(base, replay.settle(read_states(spark, path, key), key, ended), key)


def compact_states(spark: SparkSession, path: str, target: str, key: Sequence[str]) -> None:
    """Write the merged states of all batches as one, for a new states folder to start from."""
    read_states(spark, path, key).write.mode("errorifexists").parquet(f"{target}/batch_id=-1")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("long"))
