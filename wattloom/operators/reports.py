"""The standard power reports over a table of readings."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.schema import TARGET


def total_records(df: DataFrame) -> DataFrame:
    """Number of rows, undecodable ones included."""
    return df.agg(F.count("*").alias("Total_Records"))


def average_power(df: DataFrame, value: str = TARGET) -> DataFrame:
    """Mean power of the whole table, to two digits."""
    return df.agg(F.round(F.avg(value), 2).alias("Average_Power"))


def average_by(
    df: DataFrame,
    keys: Sequence[str] | Mapping[str, Column],
    value: str = TARGET,
    output: str = "AVG_POWER",
    digits: int = 2,
) -> DataFrame:
    """Mean of ``value`` per key, rounded, in key order (missing keys come first).

    ``keys`` are column names, or a mapping from output name to expression.
    """
    if not isinstance(keys, Mapping):
        keys = {k: F.col(k) for k in keys}
    grouping = [expression.alias(name) for name, expression in keys.items()]
    return (
        df.groupBy(*grouping)
        .agg(F.round(F.avg(value), digits).alias(output))
        .orderBy(*keys)
    )


def monthly_power(df: DataFrame) -> DataFrame:
    return average_by(df, ["YEAR", "MONTH"])


def daily_power(df: DataFrame) -> DataFrame:
    return average_by(df, ["YEAR", "MONTH", "DAY"])


def hourly_power(df: DataFrame) -> DataFrame:
    return average_by(df, ["HOUR"])


def power_by_plant(df: DataFrame) -> DataFrame:
    return average_by(df, ["PLANT_ID"])


def power_by_weekday(df: DataFrame) -> DataFrame:
    return average_by(df, ["DAY_OF_WEEK"])


def bucket_average(
    df: DataFrame, by: str, digits: int, value: str = TARGET, name: str | None = None
) -> DataFrame:
    """Mean of ``value`` per rounded ``by``."""
    return average_by(df, {name or by: F.round(F.col(by), digits)}, value)


def power_by_temperature(df: DataFrame) -> DataFrame:
    return bucket_average(df, "AMBIENT_TEMPERATURE", 1, name="TEMPERATURE")


def power_by_irradiation(df: DataFrame) -> DataFrame:
    return bucket_average(df, "IRRADIATION", 2)


def top_readings(
    df: DataFrame,
    by: str = TARGET,
    n: int = 10,
    columns: Sequence[str] = ("DATE_TIME", "PLANT_ID", "POWER_GENERATED"),
    ties: Sequence[str] = ("DATE_TIME", "PLANT_ID"),
) -> DataFrame:
    """The ``n`` rows with the largest ``by``; equal values are ordered by ``ties``."""
    return df.select(*columns).orderBy(F.desc(by), *ties).limit(n)


def max_power(df: DataFrame, value: str = TARGET) -> DataFrame:
    return df.agg(F.max(value).alias("MAX_POWER"))


def min_power(df: DataFrame, value: str = TARGET) -> DataFrame:
    return df.agg(F.min(value).alias("MIN_POWER"))


# Report name to report, in reading order.
REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "total_records": total_records,
    "average_power": average_power,
    "monthly": monthly_power,
    "daily": daily_power,
    "hourly": hourly_power,
    "by_plant": power_by_plant,
    "by_weekday": power_by_weekday,
    "by_temperature": power_by_temperature,
    "by_irradiation": power_by_irradiation,
    "top_power": top_readings,
    "max_power": max_power,
    "min_power": min_power,
}


def all_reports(readings: DataFrame) -> dict[str, DataFrame]:
    """Every report over one table, none of them run yet."""
    return {name: report(readings) for name, report in REPORTS.items()}
