"""A forest written out: nodes as a table, formula as one expression."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from wattloom.operators import trees
from wattloom.operators.model import PREDICTION, train_power_model
from wattloom.operators.trees import forest_column, forest_sql, tree_nodes
from wattloom.plans.telemetry import readings, table, telemetry_view
from wattloom.schema import FEATURES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def data(spark):
    return readings(telemetry_view(table(spark, SF, "events"))).cache()


@pytest.fixture(scope="module")
def model(data):
    return train_power_model(data, num_trees=6, max_depth=6)


def test_nodes_are_those_of_the_trees(model):
    rows = tree_nodes(model).collect()
    fitted = model.stages[-1]
    assert len(rows) == fitted.totalNumNodes
    for tree in range(fitted.getNumTrees):
        own = {r["NODE"]: r for r in rows if r["TREE"] == tree}
        assert len(own) == fitted.trees[tree].numNodes
        inner = [r for r in own.values() if r["FEATURE"] is not None]
        assert {r[side] for r in inner for side in ("LEFT", "RIGHT")} == set(own) - {0}
        assert {r["FEATURE"] for r in inner} <= set(FEATURES)
        assert all(own[r["LEFT"]]["ROWS"] + own[r["RIGHT"]]["ROWS"] == r["ROWS"] for r in inner)


def test_expression_gives_the_values_of_the_model(spark, model, data):
    scored = model.transform(data.withColumn("OURS", forest_column(model)))
    assert scored.where(~F.col("OURS").eqNullSafe(F.col(PREDICTION))).count() == 0
    assert scored.select("OURS").distinct().count() > 50


def test_expression_gives_the_same_doubles_in_another_engine(spark, model, data):
    scored = model.transform(data).select("SOURCE_KEY", "DATE_TIME", *FEATURES, PREDICTION).toPandas()
    con = duckdb.connect()
    con.register("scored", scored)
    same = con.execute(f"SELECT count(*), count(*) FILTER (({forest_sql(model)}) = {PREDICTION}) FROM scored")
    rows, equal = same.fetchone()
    assert rows == equal == len(scored) > 0


def test_rows_without_a_feature_have_no_prediction(spark, model, data):
    one = data.limit(1)
    nothing = forest_column(model)
    for change in (F.lit(None).cast("double"), F.lit(math.nan)):
        assert one.withColumn("AC_POWER", change).select(nothing).first()[0] is None
    assert one.withColumn("HOUR", F.lit(None).cast("int")).select(nothing).first()[0] is None
    assert one.select(nothing).first()[0] is not None


def test_large_forests_and_odd_names_are_refused(spark, model, data, monkeypatch):
    monkeypatch.setattr(trees, "EXPRESSION_NODES", 10)
    with pytest.raises(ValueError, match="nodes"):
        forest_sql(model)
    odd = train_power_model(
        data.withColumnRenamed("HOUR", "the hour"), ["the hour"], num_trees=1, max_depth=1
    )
    with pytest.raises(ValueError, match="names"):
        forest_sql(odd)
