"""Session helpers: where lineage is cut, and how an intermediate table is kept."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only for an unconfigured local session."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="tideline-")
    context.setCheckpointDir(configured)
    return configured


# Folders of the runs that are open, the innermost last.
_runs: list[str] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for the tables kept inside the block; it is removed at the end.

    A result that is to outlive the block is kept with ``materialize(df, outlive=True)``.
    """
    folder = f"{checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    _runs.append(folder)
    try:
        yield folder
    finally:
        _runs.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_path(spark: SparkSession, outlive: bool = False) -> str:
    """A path for one intermediate table below the open run's folder, or the checkpoint folder."""
    home = _runs[-1] if _runs and not outlive else f"{checkpoint_dir(spark)}/tables"
    return f"{home}/{uuid.uuid4().hex}"


def exists(path: str, spark: SparkSession) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def materialize(df: DataFrame, outlive: bool = False) -> DataFrame:
    """Write ``df`` under the checkpoint folder and return a DataFrame that reads it back.

    Used for tables that several branches of one plan read. The copy lives on shared storage, so
    a lost executor costs a re-read, not a recomputation. As a columnar table it also lets each
    branch read only its columns, and its size on disk tells Spark whether it may be broadcast.
    """
    spark = df.sparkSession
    path = new_path(spark, outlive)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
