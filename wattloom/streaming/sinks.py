"""Starting streaming queries: Parquet archive and per-batch callbacks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from wattloom.sinks.archive import BATCH_ID, DATE_COLUMNS, ROWS_PER_FILE, archive_batch_sink

# Each micro-batch writes at least one file for each date in it, so batches should not be small.
ARCHIVE_TRIGGER = {"processingTime": "1 minute"}


def _triggered(writer: DataStreamWriter, trigger: Mapping | None) -> DataStreamWriter:
    return writer.trigger(**trigger) if trigger else writer


def archive_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping | None = ARCHIVE_TRIGGER,
    partition_by: Sequence[str] = DATE_COLUMNS,
    rows_per_file: int = ROWS_PER_FILE,
) -> StreamingQuery:
    """Append the stream to a Parquet folder, each row exactly once.

    Partitioning by calendar date lets later date filters skip files.  A micro-batch
    writes as many files for a date as its rows need, at most ``rows_per_file`` in each
    or so, whatever share of the batch the date has.  ``()`` gives a flat archive, whose
    files are those of the batch's tasks.
    """
    if partition_by:
        sink = archive_batch_sink(path, checkpoint, partition_by, rows_per_file)
        return start_batches(df, sink, checkpoint, trigger=trigger)
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, trigger).start()


def start_batches(
    df: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Hand every micro-batch to ``sink``; an error in it stops the query."""
    writer = (
        df.writeStream.outputMode(output_mode)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, trigger).start()


def table_batch_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` callback that keeps each micro-batch in its own folder.

    The folder is replaced when Spark repeats the batch, so a retry leaves no
    duplicates.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH_ID}={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all micro-batches kept by :func:`table_batch_sink`, with their id."""
    layout = T.StructType([*schema.fields, T.StructField(BATCH_ID, T.LongType())])
    return spark.read.schema(layout).parquet(path)


def run_available(query: StreamingQuery) -> None:
    """Wait for a query started with ``availableNow``; its error is raised here."""
    query.awaitTermination()
