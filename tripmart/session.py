"""Session helpers: a local session for tests and benchmarks, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", app: str = "tripmart", **conf: str) -> SparkSession:
    """A single-JVM session. On a cluster the session comes from the submitter instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        # The JVM does not compile methods above 8000 bytes; larger generated ones are better split by Spark.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Without this every column expression records its Python call site, most of the time a plan takes to build.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Tasks for each core, so that one slow task does not hold up the others.
TASKS_PER_CORE = 4


def over_all_cores(df: DataFrame, *key: str) -> DataFrame:
    """``df`` dealt by a key of its rows over several tasks for each core.

    A scan has no more tasks with rows than its files have row groups. Where the work after it costs more than moving the
    rows, a large file of one row group would keep one core busy and leave the others idle.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism * TASKS_PER_CORE, *key)


# Spark keeps the shuffle files of a query until the driver collects its plan as garbage, or else until the query ends.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Folders made by ``shared_dir`` in the innermost ``scratch`` block.
_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that run inside the block go when their query ends; the setting is put back."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """The same, and intermediate tables made inside the block are deleted at its end.

    For steps that end in a write: nothing that leaves the block may read those tables.
    """
    made: list[str] = []
    outer = _SCRATCH.set(made)
    try:
        with shuffles_dropped(spark):
            yield
    finally:
        _SCRATCH.reset(outer)
        for folder in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run_folder(spark: SparkSession) -> str:
    """This application's folder for intermediate tables.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Where that is unset, the folder is kept in the
    warehouse, which is shared as well; a temporary folder of the machine is never used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tripmart/{spark.sparkContext.applicationId}"


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder that every executor can reach."""
    path = f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if _SCRATCH.get() is not None:
        _SCRATCH.get().append(path)
    return path


def clear_run_folder(spark: SparkSession) -> None:
    """Deletes the application's intermediate tables, through the file system they are on. Results that were not
    written elsewhere can no longer be read; the folder of an application that ended may go at any time."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
