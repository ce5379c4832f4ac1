"""Operators for preparing text corpora: counting, filtering, deduplication, search, packing."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()
# Texts can be long, so rows go to Python workers in batches of bounded size rather than number.
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_DEFAULT, _BATCH = "67108864b", "8m"
# Parquet readers hold that many rows of a column at a time, whatever their length, and copy them as they grow.
_READ_KEY = "spark.sql.parquet.columnarReaderBatchSize"
_READ_DEFAULT, _READ = "4096", "512"


def prepare(spark: SparkSession) -> None:
    """Make a session ready for these operators: their code, and batches that fit long texts.

    The batch sizes are set only where the session has Spark's default.
    """
    ship(spark)
    if spark.conf.get(_BATCH_KEY, _BATCH) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_KEY, _BATCH)
    if spark.conf.get(_READ_KEY, _READ) == _READ_DEFAULT:
        spark.conf.set(_READ_KEY, _READ)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, if they cannot import it as the driver does.

    A driver that found the package by a changed ``sys.path`` has workers that do not.
    With ``PYTHONPATH``, ``--py-files`` or an installed package there is nothing to do, and
    a cluster must have one of these: only a local master gets the package from here.
    """
    if not spark.sparkContext.master.startswith("local["):
        return
    package = Path(__file__).resolve().parents[1]
    root, app = package.parent, spark.sparkContext.applicationId
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if app in _SHIPPED or not package.is_dir() or root in [Path(p).resolve() for p in known if p]:
        return
    base = os.path.join(tempfile.mkdtemp(prefix="wattloom-code-"), package.name)
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", root, package.name))
    _SHIPPED.add(app)
