"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SHARED_DIR_KEY = "spark.checkpoint.dir"


def local_session(app: str, cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("VECTORLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Python workers import this package, wherever the session was started from
        .config("spark.executorEnv.PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        # call-site capture costs one stack walk per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own; on a
    cluster a missing setting is an error, because a machine-local folder would
    lose its contents together with the executor that wrote them.
    """
    named = spark.conf.get(_SHARED_DIR_KEY, None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SHARED_DIR_KEY} to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="vectorloom-"))
    return context.getCheckpointDir()


_OPEN_SCRATCH: ContextVar[list[str] | None] = ContextVar("open_scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what is written to the shared folder within the block, when the block ends.

    A result reads the tables its operators wrote, so write or collect it inside. Without such a block
    the tables stay until the folder is cleared.
    """
    token = _OPEN_SCRATCH.set([])
    try:
        yield
    finally:
        paths = _OPEN_SCRATCH.get()
        _OPEN_SCRATCH.reset(token)
        for path in paths:
            delete_path(spark, path)


@contextmanager
def noted_scratch() -> Iterator[list[str]]:
    """The paths of tables written to the shared folder within the block, for the caller to delete when they are read."""
    outer, paths = _OPEN_SCRATCH.get(), []
    token = _OPEN_SCRATCH.set(paths)
    try:
        yield paths
    finally:
        _OPEN_SCRATCH.reset(token)
        if outer is not None:
            outer.extend(paths)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder from whatever store the session reaches."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used before."""
    path = f"{shared_dir(spark).rstrip('/')}/vectorloom/{label}-{uuid.uuid4().hex}"
    if (paths := _OPEN_SCRATCH.get()) is not None:
        paths.append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    Cuts the lineage: later jobs read columnar files instead of recomputing, and a
    lost executor costs one file read.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
