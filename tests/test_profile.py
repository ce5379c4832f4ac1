from datetime import datetime

import numpy as np
import pandas as pd
import pytest

from wattloom.operators.profile import (
    describe_columns,
    describe_times,
    duplicate_count,
    iqr_bounds,
    iqr_outlier_counts,
    iqr_outliers,
    null_counts,
    profile,
    quartiles,
)

NAN = float("nan")
VALUES = [1.0, 2.0, 2.0, 3.0, 4.0, 100.0, -50.0, None, NAN]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(
        [(v, i, None if i % 3 else "s") for i, v in enumerate(VALUES)], "x double, n int, s string"
    )


@pytest.fixture
def series():
    return pd.Series([v for v in VALUES if v is not None and v == v])


def test_null_counts_take_nan_as_missing(df):
    got = {r["COLUMN_NAME"]: r["MISSING"] for r in null_counts(df).collect()}
    assert got == {"x": 2, "n": 0, "s": 6}


def test_duplicate_count(spark):
    pdf = [(1, None), (1, None), (1, NAN), (1, NAN), (1, NAN), (2, 0.0)]
    df = spark.createDataFrame(pdf, "a int, b double")
    assert duplicate_count(df).first()[0] == 3
    assert duplicate_count(df.limit(0)).first()[0] == 0


def test_describe_equals_pandas(df, series):
    row = describe_columns(df, ["x"]).first()
    want = series.describe()
    assert row["N"] == want["count"]
    for ours, theirs in zip(
        ["MEAN", "STD", "MIN", "Q25", "Q50", "Q75", "MAX"],
        ["mean", "std", "min", "25%", "50%", "75%", "max"],
    ):
        assert row[ours] == pytest.approx(want[theirs])


def test_describe_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,), (NAN,)], "x double")
    row = describe_columns(df, ["x"]).first()
    assert row["N"] == 0 and row["MEAN"] is None and row["Q50"] is None
    assert quartiles(df, ["x"]).first()["IQR"] is None
    assert iqr_outlier_counts(df, ["x"]).first()["OUTLIERS"] == 0
    assert iqr_outliers(df, "x").count() == 0


def test_describe_times(spark):
    times = [datetime(2024, 1, 1), datetime(2024, 1, 3), datetime(2024, 1, 2), None]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp")
    row = describe_times(df, ["t"]).first()
    assert (row["N"], row["MIN"], row["Q50"], row["MAX"]) == (3, times[0], times[2], times[1])
    assert row["MEAN"] == times[2] and row["Q25"] == datetime(2024, 1, 1, 12)


def test_outliers_are_strictly_outside(df, series):
    q1, q3 = series.quantile(0.25), series.quantile(0.75)
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert iqr_bounds(df, ["x"])["x"] == pytest.approx((low, high))
    want = series[(series < low) | (series > high)]
    assert iqr_outlier_counts(df, ["x"]).first()["OUTLIERS"] == len(want)
    assert sorted(r["x"] for r in iqr_outliers(df, "x").collect()) == sorted(want)
    edge = df.sparkSession.createDataFrame([(v,) for v in [0.0, 1.0, 2.0, 3.0, 5.5]], "x double")
    assert iqr_outlier_counts(edge, ["x"]).first()["OUTLIERS"] == 0


def test_outlier_fences_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("cast(id as double) as x").write.parquet(path)
    plan = iqr_outliers(spark.read.parquet(path), "x")._jdf.queryExecution().toString()
    assert "Or(LessThan(x," in plan[plan.rindex("PushedFilters") :]


def test_quartiles_exact_and_approximate(spark):
    df = spark.range(100_001).selectExpr("cast(id as double) as x")
    assert tuple(quartiles(df, ["x"]).first())[1:] == (25_000.0, 75_000.0, 50_000.0)
    row = quartiles(df, ["x"], exact=False).first()
    assert row["Q1"] == pytest.approx(25_000, abs=25) and row["Q3"] == pytest.approx(75_000, abs=25)
    summary = describe_columns(df, ["x"], exact=False).first()
    assert summary["Q50"] == pytest.approx(50_000, abs=25)


def test_profile(df):
    got = [tuple(r) for r in profile(df).orderBy("POSITION").collect()]
    assert got == [(0, "x", "double", 3, 9), (1, "n", "int", 3, 9), (2, "s", "string", 3, 9)]
    assert np.all([r[4] == df.count() for r in got])
