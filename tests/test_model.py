from datetime import datetime

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tests.test_clean import NAN, reading, table
from wattloom.operators.metrics import regression_metrics
from wattloom.operators.model import (
    dealt_rows,
    feature_importance,
    load_model,
    model_features,
    predictions_table,
    save_model,
    score_readings,
    train_power_model,
    training_layout,
)
from wattloom.plans.telemetry import readings, telemetry_view
from wattloom.plans.telemetry import table as source
from wattloom.plans.training import train_job
from wattloom.schema import FEATURES
from wattloom.sources.files import read_csv


@pytest.fixture(scope="module")
def data(spark, sf_dir):
    return readings(telemetry_view(source(spark, sf_dir, "events"))).cache()


@pytest.fixture(scope="module")
def model(data):
    return train_power_model(data, num_trees=5, max_depth=4)


def test_default_forest_matches_the_declared_settings(spark, data):
    from wattloom.operators import model as module

    seen = {}

    class Spy:
        def __init__(self, **options):
            seen.update(options)
            raise InterruptedError

    original, module.RandomForestRegressor = module.RandomForestRegressor, Spy
    try:
        with pytest.raises(InterruptedError):
            train_power_model(data)
    finally:
        module.RandomForestRegressor = original
    assert (seen["numTrees"], seen["maxDepth"], seen["seed"]) == (100, 15, 42)
    assert seen["featureSubsetStrategy"] == "all"


def test_predictions_carry_the_row_ids(model, data):
    out = predictions_table(model, data)
    assert out.columns == ["DATE_TIME", "PLANT_ID", "SOURCE_KEY", "ACTUAL_POWER", "PREDICTED_POWER"]
    assert out.count() == data.count()
    ours = regression_metrics(out).first()
    for ours_name, spark_name in [("MAE", "mae"), ("RMSE", "rmse"), ("R2", "r2")]:
        evaluator = RegressionEvaluator(
            labelCol="ACTUAL_POWER", predictionCol="PREDICTED_POWER", metricName=spark_name
        )
        assert ours[ours_name] == pytest.approx(evaluator.evaluate(out))
    assert ours["R2"] > 0.5


def test_importance_covers_all_features(model):
    rows = feature_importance(model).collect()
    assert sorted(r["FEATURE"] for r in rows) == sorted(FEATURES)
    assert sum(r["IMPORTANCE"] for r in rows) == pytest.approx(1.0)
    weights = [r["IMPORTANCE"] for r in rows]
    assert weights == sorted(weights, reverse=True)


def test_saved_model_predicts_the_same(model, data, tmp_path):
    path = str(tmp_path / "model")
    save_model(model, path)
    save_model(model, path)
    again = load_model(path)
    assert model_features(again) == FEATURES
    a, b = predictions_table(model, data), predictions_table(again, data)
    assert a.exceptAll(b).count() == 0


def test_training_skips_incomplete_rows(spark, data):
    spoiled = data.unionByName(
        table(spark, reading(DC_POWER=NAN), reading(HOUR=None), reading(POWER_GENERATED=None))
    )
    fitted = train_power_model(spoiled, num_trees=2, max_depth=2)
    assert fitted.stages[-1].getNumTrees == 2


def test_scoring_keeps_and_skips_the_right_rows(spark, model):
    rows = table(
        spark,
        reading(SOURCE_KEY="ok"),
        reading(SOURCE_KEY="bad time", DATE_TIME="yesterday"),
        reading(SOURCE_KEY="no time", DATE_TIME=None),
        reading(SOURCE_KEY="nan feature", DC_POWER=NAN),
        reading(SOURCE_KEY="null feature", DAILY_YIELD=None),
        reading(SOURCE_KEY="negative", POWER_GENERATED=-1.0),
    )
    out = score_readings(model, rows)
    assert out.columns == [
        "EVENT_TIME",
        "PREDICTION_TIME",
        "PLANT_ID",
        "SOURCE_KEY",
        "ACTUAL_POWER",
        "PREDICTED_POWER",
        "IRRADIATION",
    ]
    got = {r["SOURCE_KEY"]: r for r in out.collect()}
    assert set(got) == {"ok", "bad time"}
    assert got["ok"]["EVENT_TIME"] == datetime(2024, 1, 1, 10)
    assert got["bad time"]["EVENT_TIME"] is None
    assert got["ok"]["PREDICTION_TIME"] == got["bad time"]["PREDICTION_TIME"] is not None


def test_textual_features_are_converted_or_skipped(spark, model):
    text = table(spark, reading(SOURCE_KEY="1"), reading(SOURCE_KEY="2")).withColumn(
        "DC_POWER", F.when(F.col("SOURCE_KEY") == "1", F.lit("1.5")).otherwise(F.lit("high"))
    )
    assert [r["SOURCE_KEY"] for r in score_readings(model, text).collect()] == ["1"]


def test_train_job_keeps_everything(spark, data, tmp_path):
    model_path, csv_path = str(tmp_path / "m"), str(tmp_path / "p")
    trained = train_job(data, model_path, csv_path, num_trees=2, max_depth=3)
    n = data.count()
    assert trained.predictions.count() == n - int(n * 0.8)
    assert trained.metrics.first()["N"] == n - int(n * 0.8)
    assert trained.importance.count() == len(FEATURES)
    # The test part is the latest: no training time lies after its first time.
    first = trained.predictions.agg(F.min("DATE_TIME")).first()[0]
    assert data.where(F.col("DATE_TIME") < first).count() <= int(n * 0.8)
    stored = read_csv(spark, csv_path, trained.predictions.schema)
    assert stored.exceptAll(trained.predictions).count() == 0
    again = predictions_table(load_model(model_path), data)
    assert trained.predictions.exceptAll(again).count() == 0


def test_same_rows_give_the_same_forest_from_any_layout(spark, data):
    fits = [
        train_power_model(data.repartition(n), num_trees=4, max_depth=5, partitions=6)
        for n in (1, 7)
    ]
    one, two = (
        sorted(tuple(r) for r in predictions_table(m, data).select("SOURCE_KEY", "PREDICTED_POWER").collect())
        for m in fits
    )
    assert one == two


def test_partitions_are_those_of_the_model_not_of_the_session(spark, data):
    plan = []
    original = Pipeline.fit
    try:
        Pipeline.fit = lambda self, df: plan.append(df) or (_ for _ in ()).throw(InterruptedError)
        with pytest.raises(InterruptedError):
            train_power_model(data, partitions=5, row_id=["DATE_TIME"])
    finally:
        Pipeline.fit = original
    text = plan[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in text and ", 5" in text


def test_equal_rows_spread_over_partitions(spark):
    hot = spark.range(0, 6000, 1, 3).select(F.lit(1.5).alias("a"), F.lit(2).alias("b"))
    rows = hot.unionByName(spark.range(6000).select(F.col("id").cast("double").alias("a"), F.lit(3).alias("b")))
    dealt = dealt_rows(rows, 12).withColumn("part", F.spark_partition_id())
    sizes = [r["count"] for r in dealt.where("b = 2").groupBy("part").count().collect()]
    assert sum(sizes) == 6000 and len(sizes) == 12 and max(sizes) < 1500
    assert dealt.drop("part").exceptAll(rows).count() == rows.exceptAll(dealt.drop("part")).count() == 0


def test_many_copies_are_counted_out_in_arrays(spark, monkeypatch):
    from wattloom.operators import model as module

    monkeypatch.setattr(module, "_COPIES_AT_ONCE", 3)
    monkeypatch.setattr(module, "_COPIES_IN_ARRAY", 4)
    rows = spark.range(53).select((F.col("id") % 5 == 4).cast("int").alias("a"))
    dealt = dealt_rows(rows, 4)
    assert sorted(r["a"] for r in dealt.collect()) == sorted(r["a"] for r in rows.collect())


def test_equal_rows_give_the_same_forest_from_any_layout(spark, data):
    rows = data.unionByName(data.limit(1).crossJoin(spark.range(500)).drop("id"))
    fits = [train_power_model(rows.repartition(n), num_trees=3, max_depth=4, partitions=5) for n in (1, 6)]
    one, two = (
        sorted(tuple(r) for r in predictions_table(m, data).select("SOURCE_KEY", "PREDICTED_POWER").collect())
        for m in fits
    )
    assert one == two


def test_layout_is_kept_with_the_model(spark, data, tmp_path, monkeypatch):
    from wattloom.operators import model as module

    monkeypatch.setattr(module, "ROWS_PER_PARTITION", 20)
    fitted = train_power_model(data, num_trees=1, max_depth=1)
    n = data.count()
    assert training_layout(fitted) == {"partitions": -(-n // 20), "rows": n, "row_id": []}
    path = str(tmp_path / "model")
    save_model(fitted, path)
    assert training_layout(load_model(path)) == training_layout(fitted)
    bare = Pipeline(stages=[]).fit(data)
    assert training_layout(bare) is None
