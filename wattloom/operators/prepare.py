"""Offline preparation: union, hourly weather, master join and feature columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.missing import all_of, present
from wattloom.functions.ranking import with_global_index
from wattloom.functions.times import day_name, floor_hour, weekend_flag
from wattloom.operators.lookup_join import BROADCAST_BYTES, key_range, lookup_join, within_key_ranges
from wattloom.schema import TARGET, WEATHER_MEASURES
from wattloom.workspace import materialize


def union_sources(*frames: DataFrame) -> DataFrame:
    """Stack tables by column name; a column one of them lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def hourly_weather(
    weather: DataFrame,
    time_column: str = "DATE_TIME",
    keys: Sequence[str] = ("PLANT_ID",),
    measures: Sequence[str] = WEATHER_MEASURES,
) -> DataFrame:
    """Mean of each measure per hour and plant; missing keys and values are left out."""
    grouping = [time_column, *keys]
    return (
        weather.withColumn(time_column, floor_hour(time_column))
        .where(all_of([F.col(c).isNotNull() for c in grouping]))
        .groupBy(*grouping)
        .agg(*[F.avg(present(weather, m)).alias(m) for m in measures])
    )


def build_master(
    generation: DataFrame,
    weather_by_hour: DataFrame,
    time_column: str = "DATE_TIME",
    keys: Sequence[str] = ("PLANT_ID",),
    keep_original_time: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    generation_stored: bool = False,
    prune: bool = True,
) -> DataFrame:
    """Readings floored to the hour, each with its plant's weather; others are dropped.

    Flooring makes equal readings of one hour duplicates of each other, which a
    later ``dedupe`` merges; ``keep_original_time`` keeps the unfloored time in
    ``ORIGINAL_TIME`` so that it does not.  Readings outside the hours and plants of
    all weather are left out by plain tests, which reach the scan; ``prune=False`` spares
    times that are parsed from text the test.  ``generation_stored`` says that the
    readings are cheap to read again.
    """
    stored = materialize(weather_by_hour, "lookup")
    if prune:
        generation = within_key_ranges(generation, stored, keys)
        hours, t = key_range(stored, time_column), F.col(time_column)
        if hours is not None:
            generation = generation.where((t >= hours[0]) & (t < hours[1] + F.expr("INTERVAL 1 HOUR")))
    if keep_original_time:
        generation = generation.withColumn("ORIGINAL_TIME", F.col(time_column))
    floored = generation.withColumn(time_column, floor_hour(time_column))
    return lookup_join(
        floored,
        stored,
        [time_column, *keys],
        broadcast_bytes=broadcast_bytes,
        lookup_stored=True,
        facts_stored=generation_stored,
        prune=False,
    )


def calendar_features(
    df: DataFrame, time_column: str = "DATE_TIME", name_column: str = "DAY_NAME"
) -> DataFrame:
    """Add HOUR, DAY, MONTH, the English weekday name and the 0/1 weekend flag."""
    t = F.col(time_column)
    return df.withColumns(
        {
            "HOUR": F.hour(t),
            "DAY": F.dayofmonth(t),
            "MONTH": F.month(t),
            name_column: day_name(t),
            "IS_WEEKEND": weekend_flag(t),
        }
    )


def finalize_features(
    df: DataFrame, target: Column, time_column: str = "DATE_TIME", target_column: str = TARGET
) -> DataFrame:
    """Add YEAR, the numeric DAY_OF_WEEK (Monday = 0) and the caller's target."""
    t = F.col(time_column)
    return df.withColumns(
        {"YEAR": F.year(t), "DAY_OF_WEEK": F.weekday(t), target_column: target}
    )


def label_codes(df: DataFrame, column: str, code: str = "CODE") -> DataFrame:
    """One row per distinct value with its position in code-point order, from 0."""
    distinct = df.select(column).dropna().dropDuplicates()
    return with_global_index(distinct, [column], code, unique=True)


def label_encode(
    df: DataFrame,
    column: str,
    output: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``<column>_ENCODED``: the 0-based rank of the value among the distinct values.

    A missing value has no code.  The codes are ranked by a parallel sort and joined
    back, by broadcast while they are small.
    """
    output = output or f"{column}_ENCODED"
    codes = label_codes(df, column, output)
    return lookup_join(
        df, codes, [column], how="left", broadcast_bytes=broadcast_bytes, lookup_stored=True
    )
