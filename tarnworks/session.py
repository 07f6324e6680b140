"""Session helpers: durable lineage cuts and layouts that later joins can reuse."""

from __future__ import annotations

import tempfile
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

AQE = "spark.sql.adaptive.enabled"
WIDTH = "spark.sql.shuffle.partitions"
SUBSET_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def local_session(cores: int | str = 8, app: str = "tarnworks") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.extraJavaOptions", "-Xss8m")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get(WIDTH))


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    A local session without one gets a temporary folder. On a cluster that folder would lie on
    one machine, where the others can't read it, so there the setting is asked for.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tarnworks-"))
    return sc.getCheckpointDir()


def fresh_folder(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder, for files that are written and read again."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from the files."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``checkpoint`` for rows whose layout nobody needs: packed columns, a fraction of the bytes."""
    folder = fresh_folder(df.sparkSession, "rows")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def pinned_layout(spark: SparkSession, width: int | None = None):
    """Plan without adaptive execution while the block runs, with shuffles of ``width`` partitions.

    A checkpoint taken from an adaptive plan forgets how its rows are hashed and
    sorted. Loops that join the same keys pass after pass need that knowledge to
    avoid re-shuffling, so they take their checkpoints inside this block.
    """
    before = {k: spark.conf.get(k) for k in (AQE, WIDTH)}
    spark.conf.set(AQE, "false")
    if width is not None:
        spark.conf.set(WIDTH, str(width))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@contextmanager
def subset_keys(spark: SparkSession):
    """Let rows that are hashed by some of a join's keys meet as they lie."""
    before = spark.conf.get(SUBSET_KEYS)
    spark.conf.set(SUBSET_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(SUBSET_KEYS, before)
