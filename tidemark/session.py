"""Session helpers shared by the operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidemark", master: str | None = None, partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with the settings the library expects (UTC, adaptive execution)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # checkpoints are deleted once nothing refers to them any more, and written by this serializer
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        # without call sites on every column expression, plans are built several times faster
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="tidemark-")


def durable(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the shared folder: the rows of each partition are fixed from here on."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def shuffle_width(df: DataFrame, partitions: int | None = None) -> int:
    return partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
