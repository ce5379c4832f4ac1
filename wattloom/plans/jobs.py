"""The standing stream jobs, from a decoded-record stream to their sinks.

``records`` is a stream with ``value`` and ``timestamp`` columns, as returned by
``read_kafka``; each function starts one query and returns it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wattloom.operators.clean import clean_readings, enforce_types
from wattloom.schema import NON_NEGATIVE_COLUMNS, READING_SCHEMA, REQUIRED_COLUMNS
from wattloom.sinks.archive import DATE_COLUMNS, ROWS_PER_FILE
from wattloom.sources.messages import decode_messages
from wattloom.streaming.scoring import SCORING_TRIGGER, start_scoring
from wattloom.streaming.sinks import ARCHIVE_TRIGGER, archive_stream, start_batches
from wattloom.streaming.windows import running_totals, window_stats

BatchSink = Callable[[DataFrame, int], None]

# The statistics need these fields only; the parser skips the others.
STATISTICS_FIELDS = T.StructType(
    [READING_SCHEMA[c] for c in dict.fromkeys([*REQUIRED_COLUMNS, *NON_NEGATIVE_COLUMNS])]
)


def archive_job(
    records: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping | None = ARCHIVE_TRIGGER,
    partition_by: Sequence[str] = DATE_COLUMNS,
    rows_per_file: int = ROWS_PER_FILE,
) -> StreamingQuery:
    """Decode every message, fix its types and append it to the archive, uncleaned."""
    readings = enforce_types(decode_messages(records, arrival=None))
    return archive_stream(readings, path, checkpoint, trigger, partition_by, rows_per_file)


def window_job(
    records: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    size: str = "10 seconds",
    delay: str = "10 seconds",
    count_name: str = "TOTAL_RECORDS",
    nan_as_null: bool = False,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Statistics of clean readings per arrival-time window, each window once."""
    decoded = decode_messages(records, STATISTICS_FIELDS)
    clean = clean_readings(decoded, nan_as_null=nan_as_null)
    stats = window_stats(clean, size=size, delay=delay, count_name=count_name)
    return start_batches(stats, sink, checkpoint, trigger=trigger)


def totals_job(
    records: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    nan_as_null: bool = False,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Running statistics of all clean readings, one snapshot per micro-batch."""
    decoded = decode_messages(records, STATISTICS_FIELDS, arrival=None)
    clean = clean_readings(decoded, nan_as_null=nan_as_null)
    return start_batches(running_totals(clean), sink, checkpoint, "complete", trigger)


def scoring_job(
    records: DataFrame,
    model: PipelineModel,
    sink: BatchSink,
    checkpoint: str,
    trigger: Mapping | None = SCORING_TRIGGER,
) -> StreamingQuery:
    """Model predictions for valid readings, micro-batch by micro-batch."""
    return start_scoring(decode_messages(records, arrival=None), model, sink, checkpoint, trigger)
