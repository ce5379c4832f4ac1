"""Global row numbers without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.workspace import materialize

# monotonically_increasing_id() keeps the position inside a partition in its low bits.
_POSITION_MASK = (1 << 33) - 1


def with_global_index(
    df: DataFrame, order: Sequence[str], index: str = "ROW_INDEX", unique: bool = False
) -> DataFrame:
    """Add the 0-based position of each row in ascending ``order``, missing values last.

    Rows are range-partitioned and sorted in parallel, the sorted table is written
    once, and each partition's start is the running sum of the earlier partitions'
    row counts (one small row per partition).  Rows that tie on ``order`` are first
    given an arrival number, so equal rows may spread over several partitions; it is
    stored before the shuffle, so a repeated task sends each row the same way.
    ``unique`` says that no two rows tie and saves that step.
    """
    arrival = "_arrival"
    keys = [F.col(k).asc_nulls_last() for k in order]
    if not unique:
        df = materialize(df.withColumn(arrival, F.monotonically_increasing_id()), "arrivals")
        keys.append(F.col(arrival).asc())
    located = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop(arrival)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(_POSITION_MASK))
    )
    stored = materialize(located, "ranked")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        stored.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    )
    # One row per partition of the sort: bounded by the shuffle width.
    return (
        stored.join(F.broadcast(starts), "_part")
        .withColumn(index, F.col("_start") + F.col("_pos"))
        .drop("_part", "_pos", "_start")
    )
