"""Scoring a stream of readings with a fitted model."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wattloom.operators.model import score_readings
from wattloom.streaming.sinks import start_batches

SCORING_TRIGGER = {"processingTime": "10 seconds"}


def score_stream(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Predictions for a stream of decoded readings, computed on the executors."""
    return score_readings(model, df)


def start_scoring(
    df: DataFrame,
    model: PipelineModel,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: Mapping | None = SCORING_TRIGGER,
) -> StreamingQuery:
    """Score the stream and hand each scored micro-batch to ``sink``."""
    return start_batches(score_stream(df, model), sink, checkpoint, trigger=trigger)
