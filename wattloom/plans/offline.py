"""From raw plant files to a feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.times import MIXED_FORMATS, parse_mixed_timestamp, unreadable
from wattloom.operators.clean import dedupe
from wattloom.operators.prepare import (
    build_master,
    calendar_features,
    finalize_features,
    hourly_weather,
    label_encode,
    union_sources,
)
from wattloom.schema import GENERATION_SCHEMA, WEATHER_SCHEMA
from wattloom.sources.files import read_csv
from wattloom.workspace import materialize


def load_plants(
    spark: SparkSession, generation_paths: Sequence[str], weather_paths: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """The plants' generation files as one table, and their weather files as another."""
    generation = union_sources(*[read_csv(spark, p, GENERATION_SCHEMA) for p in generation_paths])
    weather = union_sources(*[read_csv(spark, p, WEATHER_SCHEMA) for p in weather_paths])
    return generation, weather


def master_table(
    generation: DataFrame,
    weather: DataFrame,
    formats: Sequence[str] = MIXED_FORMATS,
    errors: str = "raise",
) -> DataFrame:
    """Readings with hourly weather; times are read from text in mixed formats.

    Text that is no time fails the query.  With ``errors="null"`` such readings drop out
    of the join; :func:`rejected_times` lists them.
    """
    generation, weather = (
        df.withColumn("DATE_TIME", parse_mixed_timestamp("DATE_TIME", formats, errors))
        for df in (generation, weather)
    )
    return build_master(generation, hourly_weather(weather), prune=False)


def rejected_times(
    df: DataFrame, time_column: str = "DATE_TIME", formats: Sequence[str] = MIXED_FORMATS
) -> DataFrame:
    """The rows that have no time to join by, with ``COLUMN_NAME``, ``TEXT`` and ``REASON``."""
    text = F.col(time_column)
    reason = F.when(text.isNull(), "missing").when(unreadable(time_column, formats), "unreadable")
    return df.withColumns(
        {"COLUMN_NAME": F.lit(time_column), "TEXT": text, "REASON": reason}
    ).where(F.col("REASON").isNotNull())


def feature_table(master: DataFrame, target: Column) -> DataFrame:
    """Deduplicated readings with calendar columns, encoded source and target.

    The deduplicated table is stored, because the encoder reads it twice: its key
    column for the codes, and whole for the result.  The master table itself is not, so
    its rows are merged in one pass.
    """
    featured = materialize(calendar_features(dedupe(master, digest_first=False)), "featured")
    return finalize_features(label_encode(featured, "SOURCE_KEY"), target)
