"""Reading, routing and ordering change logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.scans import numbered
from tidemark.schema import CHANGE_SCHEMA, ORDER, commit_order, conform, is_ddl
from tidemark.session import shuffle_width


def read_change_log(spark: SparkSession, paths: str | Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Scan change records from one or many files of a Spark format."""
    listed = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.format(fmt).schema(CHANGE_SCHEMA).load(listed)


def write_change_log(log: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Append records to a change log."""
    conform(log).write.format(fmt).mode(mode).save(path)


def union_logs(*logs: DataFrame) -> DataFrame:
    """One log out of several, absent columns as NULL."""
    whole, *rest = logs
    for log in rest:
        whole = whole.unionByName(log, allowMissingColumns=True)
    return whole


def route(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(DDL records, DML records)."""
    return log.filter(is_ddl()), log.filter(~is_ddl())


def by_table(log: DataFrame, partitions: int | None = None) -> DataFrame:
    """Shuffle records by table, in commit order within each.

    Ranges of (table, commit order): small tables share a task and a table of any size spreads over several.
    """
    keys = [F.col("db_name"), F.col("table_"), *commit_order()]
    return log.repartitionByRange(shuffle_width(log, partitions), *keys).sortWithinPartitions(*keys)


def in_commit_order(log: DataFrame) -> DataFrame:
    return log.orderBy(*commit_order())


def by_priority(log: DataFrame) -> DataFrame:
    """Per table: definitions, inserts, then updates and deletes, each in commit order.

    This moves inserts ahead of deletes of the same row, so a log sorted this way is for reading, not for replay.
    """
    return log.orderBy("db_name", "table_", priority().asc(), *commit_order())


def priority():
    return F.when(is_ddl(), 0).when(F.col("op_type") == "I", 1).otherwise(2)


def skip_take(log: DataFrame, skip: int, take: int) -> DataFrame:
    """Records ``skip + 1`` to ``skip + take`` of the commit order, in no promised order of rows."""
    positions = numbered(log, commit_order())
    return positions.filter(F.col("pos").between(skip + 1, skip + take)).drop("pos")


def last_record(log: DataFrame) -> DataFrame:
    return log.orderBy(*[c.desc() for c in commit_order()]).limit(1)


def after_checkpoint(log: DataFrame, scn: int, tx_seq: int | None = None, seq: int | None = None,
                     lsn: int | None = None, dn: int | None = None) -> DataFrame:
    """Records after a checkpoint in commit order; the ``scn`` bound reaches the scan as a pushed filter.

    Each part that is given is compared after the ones before it. A checkpoint cut between records that tie on
    (scn, tx_seq, seq) must carry ``lsn``, and ``dn`` where source nodes share one; without ``seq`` the whole
    transaction of the checkpoint is read again.
    """
    if tx_seq is None:
        return log.filter(F.col("scn") > scn)
    parts = [("scn", scn), ("tx_seq", tx_seq)]
    if seq is not None:
        parts.append(("seq", seq))
        if lsn is not None:
            parts.append(("lsn", lsn))
            if dn is not None:
                parts.append(("dn", dn))
    order = dict(zip(ORDER, commit_order()))
    later = F.lit(seq is None)
    for name, value in reversed(parts):
        later = (order[name] > value) | ((order[name] == value) & later)
    return log.filter((F.col("scn") >= scn) & later)


def deduplicate(log: DataFrame) -> DataFrame:
    """One record per commit position: of differing ones, at every run, the one whose content has the smallest hash.

    The aggregate drops copies before the shuffle, however many a record has.
    """
    content = F.xxhash64(*log.columns)
    first = log.groupBy(*ORDER).agg(F.min_by(F.struct(*log.columns), content).alias("r"))
    return first.select(*[F.col("r")[c].alias(c) for c in log.columns])


def contradicting(log: DataFrame) -> DataFrame:
    """Commit positions that hold records of different content: (commit order, n)."""
    content = F.xxhash64(*log.columns)
    return log.groupBy(*ORDER).agg(F.count(F.lit(1)).alias("n"), F.min(content).alias("low"), F.max(content).alias("high")).filter(
        "low <> high").drop("low", "high")
