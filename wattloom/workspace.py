"""Shared scratch storage: where intermediate tables, checkpoints and models go.

Anything written here must be readable by every executor, so the folder is the
one the cluster names in ``spark.checkpoint.dir``.  Only a local master, where
driver and executors share one disk, may fall back to a private temp folder.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}
# Paths given out inside each open scratch block, innermost last.
_SCRATCH: list[list[str]] = []


def workspace_root(spark: SparkSession) -> str:
    """Shared folder for this application."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="wattloom-")
    return _LOCAL_ROOTS[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder; an open scratch block removes it."""
    path = f"{workspace_root(spark)}/{label}-{uuid.uuid4().hex}"
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system, wherever it is."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    """True if there is a file or folder, wherever it is."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


@contextmanager
def scratch(spark: SparkSession):
    """Remove what is stored inside the block when it ends.

    Operators store intermediate tables and return plans that read them, so results
    must be written to a place of the caller's (or collected) before the block ends.
    """
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            remove(spark, path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give the context a reliable checkpoint folder if the cluster set none."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(new_path(spark, "checkpoints"))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    The lineage ends at files that outlive any executor; later reads keep column
    pruning and filter pushdown, which an RDD checkpoint would lose.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffle_partitions(spark: SparkSession, count: int):
    """Set the shuffle width for queries started inside the block.

    A streaming query fixes its number of state partitions when it first starts,
    and adaptive execution cannot merge them later.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(count))
    try:
        yield
    finally:
        spark.conf.set(key, before)
