"""Random-forest power model on Spark ML: train, score, explain, save, load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions.missing import any_of, complete_rows, is_missing
from wattloom.functions.times import parse_event_time
from wattloom.operators.clean import validate_for_scoring
from wattloom.schema import FEATURES, NON_NEGATIVE_COLUMNS, SCORING_REQUIRED, TARGET
from wattloom.workspace import ensure_checkpoint_dir, exists

PREDICTION = "PREDICTED_POWER"
# Part of the model's definition, like its seed: other partitions give other trees.
ROWS_PER_PARTITION, LEAST_PARTITIONS = 250_000, 8
# Copies of equal rows that are dealt together, and copies that one array counts out.
_COPIES_AT_ONCE, _COPIES_IN_ARRAY = 64, 1 << 18
# Where a saved model keeps how its rows were dealt.
_TRAINING = "training"


def train_power_model(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    target: str = TARGET,
    num_trees: int = 100,
    max_depth: int = 15,
    seed: int = 42,
    partitions: int | None = None,
    row_id: Sequence[str] = (),
    **forest_options,
) -> PipelineModel:
    """Fit the forest on complete rows; every split considers all features.

    Trees draw their rows partition by partition, so the rows are dealt by a hash and
    sorted in their partition: the same rows give the same forest on any number of cores
    and from any layout.  The hash is of ``row_id``, if given, which should be unique;
    otherwise of all that a row holds and, for equal rows, of their number among their
    equals, so that they spread as well.  ``partitions`` follows from the number of rows
    unless it is given; :func:`training_layout` tells what it was.  Node ids are cached and
    checkpointed so that deep trees neither ship to all executors at each level nor
    restart from scratch when one is lost.
    """
    ensure_checkpoint_dir(df.sparkSession)
    options = {
        "featureSubsetStrategy": "all",
        "cacheNodeIds": True,
        "checkpointInterval": 10,
        "maxMemoryInMB": 512,
        **forest_options,
    }
    needed = [*features, target]
    ids = [c for c in row_id if c not in needed]
    typed = df.select(*features, F.col(target).cast("double").alias(target), *ids)
    complete = complete_rows(typed, needed)
    rows = complete.count()
    if partitions is None:
        partitions = max(LEAST_PARTITIONS, -(-rows // ROWS_PER_PARTITION))
    if row_id:
        order = [*row_id, *(c for c in needed if c not in row_id)]
        dealt = complete.repartition(partitions, F.xxhash64(*row_id))
    else:
        order, dealt = needed, dealt_rows(complete, partitions)
    forest = RandomForestRegressor(
        featuresCol="_features",
        labelCol=target,
        predictionCol=PREDICTION,
        numTrees=num_trees,
        maxDepth=max_depth,
        seed=seed,
        **options,
    )
    stages = [_assembler(features), forest]
    model = Pipeline(stages=stages).fit(dealt.sortWithinPartitions(*order).select(needed))
    model.training = {"partitions": partitions, "rows": rows, "row_id": list(row_id)}
    return model


def dealt_rows(df: DataFrame, partitions: int) -> DataFrame:
    """The rows of ``df`` dealt to partitions by a hash of what they hold.

    Equal rows are counted, map-side first, and their copies dealt a few at a time, so a
    row that is a third of the table lands in all partitions and no task lists more of
    its copies than others.  Which copies a partition gets does not depend on the layout
    of ``df``.
    """
    upto = lambda n, size: F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / size))
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    per_array = _COPIES_AT_ONCE * _COPIES_IN_ARRAY
    pieces = (
        counted.withColumn("_array", F.explode(upto(F.col("_copies"), per_array)))
        .withColumn("_left", F.least(F.col("_copies") - F.col("_array") * per_array, F.lit(per_array)))
        .withColumn("_piece", F.explode(upto(F.col("_left"), _COPIES_AT_ONCE)))
    )
    left = F.least(F.col("_left") - F.col("_piece") * _COPIES_AT_ONCE, F.lit(_COPIES_AT_ONCE))
    return (
        pieces.withColumn("_own", left)
        .repartition(partitions, F.xxhash64(*df.columns, "_array", "_piece"))
        .select(*df.columns, F.explode(F.array_repeat(F.lit(0), F.col("_own").cast("int"))).alias("_copy"))
        .drop("_copy")
    )


def training_layout(model: PipelineModel) -> dict | None:
    """Partitions, rows and row id that the model was fitted with, if they are known."""
    return getattr(model, "training", None)


def _assembler(features: Sequence[str]) -> VectorAssembler:
    # "skip" leaves out rows whose features are null or NaN.
    return VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="skip")


def model_features(model: PipelineModel) -> list[str]:
    return model.stages[0].getInputCols()


def predictions_table(model: PipelineModel, df: DataFrame, target: str = TARGET) -> DataFrame:
    """Row ids with the actual and the predicted value."""
    return model.transform(df).select(
        "DATE_TIME", "PLANT_ID", "SOURCE_KEY", F.col(target).alias("ACTUAL_POWER"), PREDICTION
    )


def score_readings(model: PipelineModel, readings: DataFrame, target: str = TARGET) -> DataFrame:
    """Score decoded readings, batch or stream, without leaving the executors.

    Invalid rows and rows with an unusable feature are skipped; a row whose event
    time cannot be read is kept with a null time.
    """
    valid = validate_for_scoring(readings)
    textual = [
        c for c in model_features(model) if isinstance(valid.schema[c].dataType, T.StringType)
    ]
    if textual:
        valid = valid.withColumns({c: F.col(c).try_cast("double") for c in textual})
    return model.transform(valid).select(
        parse_event_time("DATE_TIME").alias("EVENT_TIME"),
        F.current_timestamp().alias("PREDICTION_TIME"),
        "PLANT_ID",
        "SOURCE_KEY",
        F.col(target).alias("ACTUAL_POWER"),
        PREDICTION,
        "IRRADIATION",
    )


def skipped_readings(readings: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """The rows that :func:`score_readings` leaves out, with the ``REASON``."""
    missing = any_of([F.col(c).isNull() for c in SCORING_REQUIRED])
    negative = any_of([F.col(c) < 0 for c in NON_NEGATIVE_COLUMNS])
    unusable = any_of([is_missing(readings, c) for c in features])
    reason = (
        F.when(missing, "missing value")
        .when(negative, "negative value")
        .when(unusable, "unusable feature")
    )
    return readings.withColumn("REASON", reason).where(F.col("REASON").isNotNull())


def feature_importance(model: PipelineModel) -> DataFrame:
    """One row per feature, most important first."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(model_features(model), weights)]
    spark = SparkSession.active()
    return spark.createDataFrame(rows, "FEATURE string, IMPORTANCE double").orderBy(
        F.desc("IMPORTANCE"), "FEATURE"
    )


def save_model(model: PipelineModel, path: str) -> None:
    """Save the model and, beside it, how its rows were dealt."""
    model.write().overwrite().save(path)
    layout = training_layout(model)
    if layout is not None:
        spark = SparkSession.active()
        rows = [(layout["partitions"], layout["rows"], layout["row_id"])]
        table = spark.createDataFrame(rows, "partitions int, rows long, row_id array<string>")
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/{_TRAINING}")


def load_model(path: str) -> PipelineModel:
    model = PipelineModel.load(path)
    spark = SparkSession.active()
    if exists(spark, f"{path}/{_TRAINING}"):
        model.training = spark.read.parquet(f"{path}/{_TRAINING}").first().asDict()
    return model
