"""Parquet archive by calendar date, written batch by batch.

A date may hold most rows of a batch.  The dates are counted first, and each gets as many
files, and tasks, as its rows need; dates of few rows share a task.  A batch has a folder
of its own under the stream's and its own number, and counts as written once it is in the
manifest, so a batch that Spark repeats is replaced or, if it was complete, left alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.workspace import exists

WRITER, BATCH_ID = "WRITER", "BATCH_ID"
DATE_COLUMNS = ("YEAR", "MONTH", "DAY")
ROWS_PER_FILE = 1_000_000
# Spark leaves out folders of this name when it reads the archive as a whole.
_MANIFEST, _ENTRY = "_manifest", "ENTRY"
MANIFEST_SCHEMA = f"{WRITER} string, {BATCH_ID} long, PART string, ROWS long, FILES int"


class Share(NamedTuple):
    """The tasks that write one date of a batch: ``files`` of them from ``first`` on."""

    first: int
    files: int


def share_tasks(rows: Sequence[int], rows_per_file: int) -> tuple[list[Share], int]:
    """Tasks for dates of so many rows each, and how many tasks there are in all.

    A date of more than ``rows_per_file`` rows has tasks of its own, of at most so many
    rows on average; neighbouring smaller dates fill a task up to that number.
    """
    shares, tasks, room = [], 0, 0
    for n in rows:
        if n > rows_per_file:
            files = -(-n // rows_per_file)
            shares.append(Share(tasks, files))
            tasks, room = tasks + files, 0
            continue
        if n > room:
            tasks, room = tasks + 1, rows_per_file
        room -= n
        shares.append(Share(tasks - 1, 1))
    return shares, tasks


def _folder(path: str, writer: str, batch_id: int) -> str:
    return f"{path}/{WRITER}={writer}/{BATCH_ID}={batch_id}"


def _entry(path: str, writer: str, batch_id: int) -> str:
    return f"{path}/{_MANIFEST}/{_ENTRY}={writer}-{batch_id}"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Rows and files of each date of each complete batch of an archive."""
    return spark.read.schema(MANIFEST_SCHEMA).json(f"{path}/{_MANIFEST}").drop(_ENTRY)


def _is_complete(spark: SparkSession, path: str, writer: str, batch_id: int) -> bool:
    entry = _entry(path, writer, batch_id)
    return exists(spark, entry) and not spark.read.schema(MANIFEST_SCHEMA).json(entry).isEmpty()


def write_archive_batch(
    batch: DataFrame,
    path: str,
    writer: str,
    batch_id: int,
    partition_by: Sequence[str] = DATE_COLUMNS,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Write one batch and enter it in the manifest; a complete batch is left as it is.

    The driver gets one number for each date of the batch.  Rows of a date are spread
    over its files by a hash of their position in the input partition, so equal rows part
    too; a missing date is a date of its own.
    """
    spark = batch.sparkSession
    if _is_complete(spark, path, writer, batch_id):
        return
    # Read twice: for the counts and for the files.
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = batch.groupBy(*partition_by).agg(F.count("*").alias("_rows")).collect()
        counts.sort(key=lambda r: [(r[c] is not None, r[c]) for c in partition_by])
        shares, tasks = share_tasks([r["_rows"] for r in counts], rows_per_file)
        if counts:
            _write_dates(batch, _folder(path, writer, batch_id), partition_by, counts, shares, tasks)
    finally:
        batch.unpersist()
    entries = [
        (writer, batch_id, "/".join(f"{c}={r[c]}" for c in partition_by), r["_rows"], s.files)
        for r, s in zip(counts, shares)
    ]
    # An empty batch is entered as well, or a reader could not tell it from a failed one.
    entries = entries or [(writer, batch_id, "", 0, 0)]
    (
        spark.createDataFrame(entries, MANIFEST_SCHEMA)
        .coalesce(1)
        .write.mode("overwrite")
        .json(_entry(path, writer, batch_id))
    )


def _write_dates(
    batch: DataFrame,
    folder: str,
    partition_by: Sequence[str],
    counts: Sequence[Row],
    shares: Sequence[Share],
    tasks: int,
) -> None:
    layout = T.StructType(
        [T.StructField(f"_{c}", batch.schema[c].dataType) for c in partition_by]
        + [T.StructField("_first", T.IntegerType()), T.StructField("_files", T.IntegerType())]
    )
    rows = [(*(r[c] for c in partition_by), *s) for r, s in zip(counts, shares)]
    plan = batch.sparkSession.createDataFrame(rows, layout)
    same = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in partition_by]
    )
    placed = batch.withColumn("_spot", F.monotonically_increasing_id()).join(F.broadcast(plan), same)
    spot = F.pmod(F.xxhash64("_spot"), F.col("_files"))
    (
        placed.repartitionById(tasks, (F.col("_first") + spot).cast("int"))
        .select(*batch.columns)
        .write.mode("overwrite")
        .partitionBy(*partition_by)
        .parquet(folder)
    )


def archive_batch_sink(
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = DATE_COLUMNS,
    rows_per_file: int = ROWS_PER_FILE,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` callback that archives each batch exactly once.

    Batches are kept apart by the id that Spark gave the stream when it first wrote its
    ``checkpoint``: a stream that starts over counts as another writer.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"]
        write_archive_batch(batch, path, writer, batch_id, partition_by, rows_per_file)

    return write


def read_batches_of_archive(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame | None:
    """Rows of the complete batches, or None for a folder that has no manifest."""
    if not exists(spark, f"{path}/{_MANIFEST}"):
        return None
    reader = spark.read.option("basePath", path)
    if schema is not None:
        own = [T.StructField(WRITER, T.StringType()), T.StructField(BATCH_ID, T.LongType())]
        reader = reader.schema(T.StructType([*schema.fields, *own]))
    complete = manifest(spark, path).where("ROWS > 0").select(WRITER, BATCH_ID).distinct()
    if complete.isEmpty():
        return spark.createDataFrame([], schema) if schema is not None else None
    # One row for each batch: the folders of others are not read.
    rows = reader.parquet(path).join(F.broadcast(complete), [WRITER, BATCH_ID], "left_semi")
    return rows.drop(WRITER, BATCH_ID)
