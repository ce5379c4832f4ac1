from datetime import datetime, timedelta

import pytest

from wattloom.operators.metrics import regression_metrics
from wattloom.operators.split import time_split

START = datetime(2024, 1, 1)


def make(spark, hours):
    data = [(i, None if h is None else START + timedelta(hours=h)) for i, h in enumerate(hours)]
    return spark.createDataFrame(data, "i int, t timestamp")


def expected(hours, fraction):
    order = sorted(range(len(hours)), key=lambda i: (hours[i] is None, hours[i] or 0, i))
    cut = int(len(hours) * fraction)
    return set(order[:cut]), set(order[cut:])


@pytest.mark.parametrize("limit", [1, 100_000])
@pytest.mark.parametrize("fraction", [0.0, 0.5, 0.8, 1.0])
@pytest.mark.parametrize(
    "hours",
    [
        list(range(20, 0, -1)),
        [5] * 11,
        [1, 2, 2, 2, 2, 2, 2, 9],
        [3, None, 1, None, None, 2],
        [None, None, None],
        [1],
    ],
)
def test_equals_a_full_sort(spark, hours, fraction, limit):
    train, test = time_split(make(spark, hours), "t", ["i"], fraction, candidate_limit=limit)
    got = {r["i"] for r in train.collect()}, {r["i"] for r in test.collect()}
    assert got == expected(hours, fraction)
    assert train.columns == test.columns == ["i", "t"]


def test_empty_table(spark):
    train, test = time_split(make(spark, [1]).limit(0), "t", ["i"])
    assert train.count() == test.count() == 0


def test_identical_rows_are_divided_exactly(spark):
    df = make(spark, [1] * 10).select("t")
    train, test = time_split(df, "t", [])
    assert (train.count(), test.count()) == (8, 2)


def test_incomplete_rows_are_dropped_before_counting(spark):
    nan = float("nan")
    data = [(i, START + timedelta(hours=i), nan if i == 3 else None if i == 4 else 1.0) for i in range(12)]
    df = spark.createDataFrame(data, "i int, t timestamp, x double")
    train, test = time_split(df, "t", ["i"], complete=["x"])
    assert [r["i"] for r in train.orderBy("i").collect()] == [0, 1, 2, 5, 6, 7, 8, 9]
    assert [r["i"] for r in test.orderBy("i").collect()] == [10, 11]


def test_zoneless_time(spark):
    df = make(spark, range(10)).selectExpr("i", "cast(t as timestamp_ntz) as t")
    train, test = time_split(df, "t", ["i"])
    assert (train.count(), test.count()) == (8, 2)


def test_metrics_of_a_formula(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 1.0)], "ACTUAL_POWER double, PREDICTED_POWER double")
    row = regression_metrics(df).first()
    assert row["N"] == 3
    assert row["MAE"] == pytest.approx(4 / 3)
    assert row["RMSE"] == pytest.approx((10 / 3) ** 0.5)
    assert row["R2"] == pytest.approx(1 - 10 / (14 / 3))


def test_metrics_of_a_constant_label(spark):
    schema = "ACTUAL_POWER double, PREDICTED_POWER double"
    assert regression_metrics(spark.createDataFrame([(2.0, 2.0)] * 3, schema)).first()["R2"] == 1.0
    assert regression_metrics(spark.createDataFrame([(2.0, 3.0)] * 3, schema)).first()["R2"] == 0.0
