"""Train the power model on a feature table and keep all of its results."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from wattloom.operators.metrics import regression_metrics
from wattloom.operators.model import (
    feature_importance,
    predictions_table,
    save_model,
    train_power_model,
)
from wattloom.operators.split import time_split
from wattloom.schema import FEATURES, TARGET
from wattloom.sinks.files import write_csv
from wattloom.workspace import materialize


@dataclass
class Training:
    """A fitted model with its test predictions, their quality and the feature weights."""

    model: PipelineModel
    predictions: DataFrame
    metrics: DataFrame
    importance: DataFrame


def train_job(
    features: DataFrame,
    model_path: str,
    predictions_path: str | None = None,
    tie_columns: Sequence[str] = ("PLANT_ID", "SOURCE_KEY"),
    fraction: float = 0.8,
    **forest_options,
) -> Training:
    """Split by time, fit on the earlier part, score the later one once, save both.

    The features are stored first, because split, fit and scoring each read them.
    ``predictions_path`` takes the test predictions as CSV.  They are stored before
    anything reads them, so the test rows pass the forest a single time.
    """
    features = materialize(features, "features")
    train, test = time_split(
        features, "DATE_TIME", tie_columns, fraction, complete=[*FEATURES, TARGET]
    )
    model = train_power_model(train, **forest_options)
    save_model(model, model_path)
    predictions = materialize(predictions_table(model, test), "predictions")
    if predictions_path:
        write_csv(predictions, predictions_path)
    return Training(model, predictions, regression_metrics(predictions), feature_importance(model))
