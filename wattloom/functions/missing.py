"""One notion of "missing" for null and NaN."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATING = (T.DoubleType, T.FloatType)


def is_missing(df: DataFrame, name: str) -> Column:
    """True where the column is null or, for floating types, NaN."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, _FLOATING):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def present(df: DataFrame, name: str) -> Column:
    """The value, with NaN turned into null."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, _FLOATING):
        return F.when(~F.isnan(c), c)
    return c


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every floating column."""
    return df.select([present(df, name).alias(name) for name in df.columns])


def all_of(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def any_of(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is null or NaN.

    The same rows as ``dropna``, but one test per column, which the scan can take
    over one by one.
    """
    tests = [F.col(c).isNotNull() for c in columns]
    tests += [
        ~F.isnan(F.col(c)) for c in columns if isinstance(df.schema[c].dataType, _FLOATING)
    ]
    return df.where(all_of(tests))
