"""Regression quality as plain aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(
    df: DataFrame, label: str = "ACTUAL_POWER", prediction: str = "PREDICTED_POWER"
) -> DataFrame:
    """Mean absolute error, root mean squared error and R² in one pass.

    R² of a constant label is 1 for a perfect fit and 0 otherwise.
    """
    y = F.col(label)
    error = y - F.col(prediction)
    sums = df.agg(
        F.count("*").alias("n"),
        F.avg(F.abs(error)).alias("MAE"),
        F.avg(error * error).alias("mse"),
        F.var_pop(y).alias("spread"),
    )
    r2 = F.when(F.col("spread") > 0, 1 - F.try_divide(F.col("mse"), F.col("spread"))).otherwise(
        F.when(F.col("mse") == 0, 1.0).when(F.col("mse") > 0, 0.0)
    )
    return sums.select(F.col("n").alias("N"), "MAE", F.sqrt("mse").alias("RMSE"), r2.alias("R2"))
