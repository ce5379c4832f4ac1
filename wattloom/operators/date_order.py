"""Which of two orders, month first or day first, the dates of a source are written in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.times import MIXED_FORMATS, MIXED_FORMATS_DAY_FIRST, parse_mixed_timestamp
from wattloom.operators.lookup_join import lookup_join

MONTH_FIRST, DAY_FIRST, BOTH_ORDERS, NO_EVIDENCE = "month first", "day first", "both", "none"
_YEAR_LAST = r"^\s*(\d{1,2})([-/.])(\d{1,2})\2\d{4}(?!\d)"
_KINDS = ["MONTH_FIRST_ONLY", "DAY_FIRST_ONLY", "EITHER_ORDER", "SAME_IN_BOTH", "NOT_YEAR_LAST"]


def order_kind(text: Column) -> Column:
    """How a date can be read; null for a missing text.

    Of dates that end with the year: in one order only, in either with different results,
    in both with the same one.  All other texts have no order.
    """
    first = F.regexp_extract(text, _YEAR_LAST, 1).try_cast("int")
    second = F.regexp_extract(text, _YEAR_LAST, 3).try_cast("int")
    month = first.between(1, 12) & second.between(1, 31)
    day = second.between(1, 12) & first.between(1, 31)
    return F.when(
        text.isNotNull(),
        F.when(month & day & (first == second), _KINDS[3])
        .when(month & day, _KINDS[2])
        .when(month, _KINDS[0])
        .when(day, _KINDS[1])
        .otherwise(_KINDS[4]),
    )


def date_order_evidence(df: DataFrame, time_column: str, source: Sequence[str]) -> DataFrame:
    """One row for each source: its dates by how they can be read, and the order these prove.

    ``DATE_ORDER`` is the only order that some date needs, ``both`` if dates need either,
    or ``none`` if every date fits both.  Rows without a text count for nothing.
    """
    kind = order_kind(F.col(time_column))
    counted = (
        df.select(*source, kind.alias("_kind"))
        .groupBy(*source)
        .agg(*[F.count_if(F.coalesce(F.col("_kind") == k, F.lit(False))).alias(k) for k in _KINDS])
    )
    month, day = F.col(_KINDS[0]) > 0, F.col(_KINDS[1]) > 0
    return counted.withColumn(
        "DATE_ORDER",
        F.when(month & day, BOTH_ORDERS)
        .when(month, MONTH_FIRST)
        .when(day, DAY_FIRST)
        .otherwise(NO_EVIDENCE),
    )


def _with_order(df: DataFrame, evidence: DataFrame, source: Sequence[str]) -> DataFrame:
    # A source may be missing, and a join by a missing key finds nothing.
    named = {f"_source_{i}": F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for i, c in enumerate(source)}
    orders = evidence.select(*[c.alias(n) for n, c in named.items()], "DATE_ORDER")
    return lookup_join(df.withColumns(named), orders, list(named), how="left").drop(*named)


def parse_by_evidence(
    df: DataFrame, time_column: str, source: Sequence[str], evidence: DataFrame | None = None
) -> DataFrame:
    """``df`` with its times read in the order that the dates of their source prove.

    Sources of both orders or of no evidence are read month first; their dates that fit
    both are what :func:`ambiguous_dates` lists.
    """
    evidence = date_order_evidence(df, time_column, source) if evidence is None else evidence
    day_first = F.col("DATE_ORDER") == DAY_FIRST
    parsed = F.when(day_first, parse_mixed_timestamp(time_column, MIXED_FORMATS_DAY_FIRST)).otherwise(
        parse_mixed_timestamp(time_column, MIXED_FORMATS)
    )
    return _with_order(df, evidence, source).withColumn(time_column, parsed).drop("DATE_ORDER")


def ambiguous_dates(
    df: DataFrame, time_column: str, source: Sequence[str], evidence: DataFrame | None = None
) -> DataFrame:
    """The rows whose date fits both orders while their source proves neither, or both."""
    evidence = date_order_evidence(df, time_column, source) if evidence is None else evidence
    doubtful = F.col("DATE_ORDER").isin(BOTH_ORDERS, NO_EVIDENCE)
    either = F.col("_kind") == _KINDS[2]
    kinds = df.withColumn("_kind", order_kind(F.col(time_column))).where(either)
    return _with_order(kinds, evidence, source).where(doubtful).drop("_kind")
