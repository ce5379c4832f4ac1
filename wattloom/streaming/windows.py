"""Windowed and running statistics; the same code serves tables and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.schema import TARGET
from wattloom.sources.messages import ARRIVAL


def _statistics(count_name: str) -> list[Column]:
    return [
        F.count("*").alias(count_name),
        F.avg(TARGET).alias("AVG_POWER"),
        F.max(TARGET).alias("MAX_POWER"),
        F.min(TARGET).alias("MIN_POWER"),
        F.avg("IRRADIATION").alias("AVG_IRRADIATION"),
    ]


def window_stats(
    df: DataFrame,
    time_column: str = ARRIVAL,
    size: str = "10 seconds",
    delay: str = "10 seconds",
    count_name: str = "TOTAL_RECORDS",
) -> DataFrame:
    """Five statistics per tumbling window.

    On a stream, a window is emitted once the latest time seen passes its end by
    ``delay``; rows that arrive later are dropped, and the newest windows wait for
    later data.  On a table, every window is returned.
    """
    span = F.col("window")
    grouped = df.withWatermark(time_column, delay).groupBy(
        F.window(time_column, size).alias("window")
    )
    return grouped.agg(*_statistics(count_name)).select(
        span["start"].alias("WINDOW_START"),
        span["end"].alias("WINDOW_END"),
        count_name,
        "AVG_POWER",
        "MAX_POWER",
        "MIN_POWER",
        "AVG_IRRADIATION",
    )


def running_totals(df: DataFrame) -> DataFrame:
    """The same five statistics over everything seen so far, as one row.

    Run it in complete mode: each micro-batch then yields a new snapshot.
    """
    return df.groupBy().agg(*_statistics("TOTAL_RECORDS"))
