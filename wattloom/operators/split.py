"""Chronological train / test split at an exact row count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.missing import complete_rows
from wattloom.functions.order_stats import CANDIDATE_LIMIT, select_ranks, sketch
from wattloom.functions.ranking import with_global_index


def time_split(
    df: DataFrame,
    time_column: str,
    tie_columns: Sequence[str] = (),
    fraction: float = 0.8,
    complete: Sequence[str] = (),
    candidate_limit: int = CANDIDATE_LIMIT,
) -> tuple[DataFrame, DataFrame]:
    """First ``int(fraction * rows)`` rows in time order, and the rest.

    Rows missing any of ``complete`` are dropped first; rows without a time come
    last.  The table is never sorted: the time of the first test row is found as an
    exact order statistic, and only rows at that very time are ranked, by
    ``tie_columns``, to place the remainder.
    """
    if complete:
        df = complete_rows(df, complete)
    t = F.col(time_column)
    micros = df.select(F.unix_micros(t.cast("timestamp")).alias("t"))
    counted = micros.agg(
        F.count("*").alias("rows"),
        F.count("t").alias("timed"),
        F.min("t").alias("first"),
        F.max("t").alias("last"),
        sketch(micros, "t", [fraction]).alias("sketch"),
    ).first()
    train_rows = int(counted["rows"] * fraction)

    if train_rows < counted["timed"]:
        ranges = {"t": (counted["timed"], counted["first"], counted["last"])}
        # Rows without a time move the rank among the others, so only a complete column was sketched at it.
        sketches = {"t": ([fraction], counted["sketch"])} if counted["timed"] == counted["rows"] else None
        found = select_ranks(micros, {"t": [train_rows]}, ranges, candidate_limit, sketches)
        cut = found[("t", train_rows)]
        at = F.timestamp_micros(F.lit(cut.value)).cast(df.schema[time_column].dataType)
        earlier, boundary, later = t < at, t == at, (t > at) | t.isNull()
        remainder, ties = train_rows - cut.before, cut.copies
    else:
        earlier, boundary, later = t.isNotNull(), t.isNull(), F.lit(False)
        remainder, ties = train_rows - counted["timed"], counted["rows"] - counted["timed"]

    if remainder == 0:
        return df.where(earlier), df.where(boundary | later)
    if remainder == ties:
        return df.where(earlier | boundary), df.where(later)
    ranked = with_global_index(df.where(boundary), tie_columns, "_rank")
    return (
        df.where(earlier).unionByName(ranked.where(F.col("_rank") < remainder).drop("_rank")),
        df.where(later).unionByName(ranked.where(F.col("_rank") >= remainder).drop("_rank")),
    )
