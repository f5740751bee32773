"""Cutting lineage and pinning small results, both safe when executors are lost."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A result of at most this many rows may be collected and broadcast.
SMALL_ROWS = 10_000


@cache
def _local_folder() -> str:
    """A folder of this process for local runs without a setting, deleted when it ends."""
    folder = tempfile.mkdtemp(prefix="tablewright-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; one of this process only in local mode without such a setting.

    The caller's own checkpoint folder is used, never changed.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared one."""
    return f"{checkpoint_root(spark)}/scratch-{uuid4().hex}"


def stage(df: DataFrame, name: str = "stage", even: bool = False, **options) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Multi-pass operators read the written table, so joins below are not run again,
    lost executors cost a re-read only, and Catalyst sees true sizes. With ``even`` adaptive
    execution first evens out the partitions, for a table that many queries scan. ``options`` are those of the writer.
    """
    path = f"{checkpoint_root(df.sparkSession)}/{name}-{uuid4().hex}"
    (df.hint("rebalance") if even else df).write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pin_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Make a result cheap to join.

    Up to ``max_rows`` rows it becomes a broadcast side. Beyond that it is staged and
    joined by shuffle, where adaptive execution splits skewed partitions.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return stage(df, "pinned")
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def discard(df: DataFrame) -> None:
    """Delete a table that ``stage`` has written, once a later one holds all that is needed of it."""
    spark, root = df.sparkSession, checkpoint_root(df.sparkSession).removeprefix("file://").removeprefix("file:")
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if root in folder:
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
