"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import shared_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of this application in the shared one; ``clear`` removes them all."""
    return f"{shared_dir(spark).rstrip('/')}/tidemark-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Delete what this application has staged; DataFrames that still read it can't be used afterwards."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/tidemark-llm/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Rows and bytes of a batch on its way to Python while a table is staged: whole texts in batches of the default
#: 10,000 rows would be held several times over.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": "2m"}

#: What a staged table was shuffled with goes as soon as the table is written, not when the driver collects its garbage.
WRITTEN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

_passing: list[list[DataFrame]] = []


@contextmanager
def small_batches(spark: SparkSession, more: dict[str, str] = {}) -> Iterator[None]:
    settings = BATCH | more
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: computed once, safe from lost executors."""
    path = new_folder(df.sparkSession, name)
    with small_batches(df.sparkSession, WRITTEN):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    if _passing:
        _passing[-1].append(out)
    return out


@contextmanager
def passing() -> Iterator[None]:
    """Tables staged inside are deleted at the end: what is needed after it is staged inside ``lasting``."""
    _passing.append([])
    try:
        yield
    finally:
        discard(*_passing.pop())


@contextmanager
def lasting() -> Iterator[None]:
    """Tables staged inside outlive the ``passing`` around it."""
    outer = _passing[:]
    _passing.clear()
    try:
        yield
    finally:
        _passing[:] = outer


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.staged_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Bits of the bitmap of ``without``; at most 2^(WITHOUT_BITS - 6) numbers are broadcast.
WITHOUT_BITS = 24


def without(docs: DataFrame, key: Column, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``key``, a bigint, is not in the one column of ``gone``.

    A bitmap of fixed size tells most rows that stay; only the others, with all they hold, are shuffled to be compared.
    """
    hashed = F.xxhash64(key)
    place, bit = F.shiftright(hashed.bitwiseAND(F.lit((1 << WITHOUT_BITS) - 1)), 6), hashed.bitwiseAND(F.lit(63)).cast("int")
    named = gone.toDF("gone").filter("gone IS NOT NULL").distinct()
    low = F.xxhash64("gone").bitwiseAND(F.lit((1 << WITHOUT_BITS) - 1))
    words = named.select(F.shiftright(low, 6).alias("word"), low.bitwiseAND(F.lit(63)).cast("int").alias("bit")).groupBy("word").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    # columns of docs stay apart from those of the joins
    row = docs.select(F.struct("*").alias("row"), key.alias("key"), place.alias("place"), bit.alias("bit"))
    marked = row.join(F.broadcast(words), F.col("place") == F.col("word"), "left")
    perhaps = F.coalesce(F.getbit("bits", "bit") == 1, F.lit(False))
    sure = marked.filter(~perhaps).select("row.*")
    return sure.unionByName(marked.filter(perhaps).join(named, F.col("key") == F.col("gone"), "left_anti").select("row.*"))


def released(run):
    """A function over batches that gives memory back when its task ends: Python workers live on, and the C library keeps
    what they have freed (a worker that has encoded a split held 424 MB, and 92 MB after this)."""
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):  # other C libraries have no such call
                ctypes.CDLL(None).malloc_trim(0)
    return wrapped


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
