"""Counts of what a stream drops, kept in a table by micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wattloom.functions.missing import all_of, any_of, is_missing
from wattloom.functions.times import parse_event_time
from wattloom.schema import NON_NEGATIVE_COLUMNS, REQUIRED_COLUMNS
from wattloom.sources.messages import ARRIVAL
from wattloom.streaming.sinks import BATCH_ID, start_batches
from wattloom.workspace import exists

BatchSink = Callable[[DataFrame, int], None]

TOTAL, KEPT = "TOTAL", "KEPT"
REASONS = ("UNDECODABLE", "INCOMPLETE", "NEGATIVE", "LATE")
# The latest arrival among clean rows: it moves the watermark of later batches.
LATEST = "LATEST_MICROS"


def reject_reason(df: DataFrame, nan_as_null: bool = False) -> Column:
    """Why cleaning drops a decoded row, or null; the first reason counts.

    A row without any value comes from a message that could not be read.  A row is
    incomplete if a required value is missing or the time is no time, and negative if a
    measure that must not be negative is, or is missing.
    """
    fields = [f.name for f in df.schema.fields if f.name != ARRIVAL]
    gone = lambda c: is_missing(df, c) if nan_as_null else F.col(c).isNull()
    time = F.col("DATE_TIME")
    if isinstance(df.schema["DATE_TIME"].dataType, T.StringType):
        time = parse_event_time("DATE_TIME")
    incomplete = any_of([time.isNull(), *[is_missing(df, c) for c in REQUIRED_COLUMNS if c != "DATE_TIME"]])
    negative = any_of([gone(c) | (F.col(c) < 0) for c in NON_NEGATIVE_COLUMNS])
    return (
        F.when(all_of([F.col(c).isNull() for c in fields]), REASONS[0])
        .when(incomplete, REASONS[1])
        .when(negative, REASONS[2])
    )


def reject_measures(reason: Column) -> dict[str, Column]:
    """Aggregates: rows in all, rows kept, and rows by reason."""
    by_reason = {r: F.count_if(F.coalesce(reason == r, F.lit(False))) for r in REASONS}
    return {TOTAL: F.count(F.lit(1)), KEPT: F.count_if(reason.isNull()), **by_reason}


def _store(spark: SparkSession, path: str, batch_id: int, row: Mapping[str, object]) -> None:
    layout = T.StructType([T.StructField(c, T.LongType()) for c in row])
    frame = spark.createDataFrame([tuple(row.values())], layout)
    frame.write.mode("overwrite").parquet(f"{path}/{BATCH_ID}={batch_id}")


def counted_sink(
    sink: BatchSink, measures: Callable[[DataFrame], Mapping[str, Column]], path: str
) -> BatchSink:
    """A ``foreachBatch`` callback that counts the rows which ``sink`` reads, in the same pass.

    ``measures`` gives named aggregates of a batch that are whole numbers.  They are
    observed while ``sink`` first reads the batch and kept under its id, so a batch that
    Spark repeats replaces its counts.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"batch {batch_id}")
        columns = [c.alias(n) for n, c in measures(batch).items()]
        sink(batch.observe(seen, *columns), batch_id)
        _store(batch.sparkSession, path, batch_id, seen.get)

    return write


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts of all micro-batches, with their id; empty before the first one."""
    names = [TOTAL, KEPT, *REASONS, LATEST, BATCH_ID]
    layout = T.StructType([T.StructField(c, T.LongType()) for c in names])
    if not exists(spark, path):
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).parquet(path)


def count_window_rejects(
    decoded: DataFrame,
    path: str,
    checkpoint: str,
    size: str = "10 seconds",
    delay: str = "10 seconds",
    nan_as_null: bool = False,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Count, batch by batch, the rows that windowed statistics of the stream leave out.

    A clean row is late if its window ended by the watermark of its batch: the latest
    arrival of a clean row in earlier batches less ``delay``, to the millisecond.
    That arrival is kept with the counts of each batch, so the rule holds over restarts
    and repeated batches.  The counts are those of the statistics job if both take the
    same batches, that is, have the same trigger and source limits.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = read_counts(spark, path).where(F.col(BATCH_ID) < batch_id)
        latest = earlier.agg(F.max(LATEST)).first()[0]
        at = F.unix_micros(F.col(ARRIVAL).cast("timestamp"))
        flagged = batch.withColumns(
            {"_clean": reject_reason(batch, nan_as_null), "_at": at, "_end": _window_end(at, size)}
        )
        late = F.lit(False)
        if latest is not None:
            # Watermarks have whole milliseconds and start at the epoch.
            late = F.col("_end") <= F.greatest(F.lit(latest // 1000 * 1000) - _micros(delay), F.lit(0))
        reason = F.coalesce("_clean", F.when(late, REASONS[3]))
        newest = F.max(F.when(F.col("_clean").isNull(), F.col("_at")))
        measures = {**reject_measures(reason), LATEST: newest}
        row = flagged.agg(*[c.alias(n) for n, c in measures.items()]).first()
        _store(spark, path, batch_id, row.asDict())

    return start_batches(decoded, write, checkpoint, trigger=trigger)


def _micros(span: str) -> Column:
    return F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {span}"))


def _window_end(micros: Column, size: str) -> Column:
    """End of the tumbling window that holds the time."""
    return micros - F.pmod(micros, _micros(size)) + _micros(size)
