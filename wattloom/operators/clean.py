"""Type enforcement, cleaning and validation of readings (batch or stream)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions.missing import all_of, complete_rows, nan_to_null
from wattloom.functions.times import parse_event_time
from wattloom.operators.lookup_join import BROADCAST_BYTES, table_bytes
from wattloom.schema import (
    NON_NEGATIVE_COLUMNS,
    READING_SCHEMA,
    REQUIRED_COLUMNS,
    SCORING_REQUIRED,
)
from wattloom.workspace import materialize

# Bytes of a row from which on a digest of it is much smaller.
WIDE_ROW = 64
_DIGESTS = ("_digest_1", "_digest_2")


def enforce_types(df: DataFrame, schema: T.StructType = READING_SCHEMA) -> DataFrame:
    """Cast the schema's columns to their declared types; unconvertible values become null.

    Columns that already have the type pass through, so the step costs nothing on
    decoded messages.  Columns outside the schema are kept as they are.
    """
    declared = {f.name: f.dataType for f in schema.fields}
    return df.select(
        [
            F.col(f.name)
            if declared.get(f.name, f.dataType) == f.dataType
            else F.col(f.name).try_cast(declared[f.name]).alias(f.name)
            for f in df.schema.fields
        ]
    )


def with_event_time(df: DataFrame, column: str = "DATE_TIME") -> DataFrame:
    """Turn a text column into a timestamp; unreadable text becomes null."""
    return df.withColumn(column, parse_event_time(column))


def clean_readings(
    df: DataFrame,
    required: Sequence[str] = REQUIRED_COLUMNS,
    non_negative: Sequence[str] = NON_NEGATIVE_COLUMNS,
    time_column: str = "DATE_TIME",
    nan_as_null: bool = False,
) -> DataFrame:
    """Parse the event time, drop incomplete rows and physically impossible ones.

    A required column must be neither null nor NaN.  A non-negative column must not
    be null, but NaN counts as larger than any number and stays; ``nan_as_null``
    drops those rows too.
    """
    if isinstance(df.schema[time_column].dataType, T.StringType):
        df = with_event_time(df, time_column)
    if nan_as_null:
        df = nan_to_null(df)
    return complete_rows(df, required).where(all_of([F.col(c) >= 0 for c in non_negative]))


def validate_for_scoring(
    df: DataFrame,
    required: Sequence[str] = SCORING_REQUIRED,
    non_negative: Sequence[str] = NON_NEGATIVE_COLUMNS,
) -> DataFrame:
    """Rows fit for the model: required columns not null, measures not negative.

    The event time stays text and is not checked here; NaN passes both tests.
    """
    tests = [F.col(c).isNotNull() for c in required] + [F.col(c) >= 0 for c in non_negative]
    return df.where(all_of(tests))


def is_wide(df: DataFrame) -> bool:
    """True if a row takes much more room than a digest of it: more than eight columns or so."""
    fixed = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
    return sum(8 if isinstance(f.dataType, fixed) else 24 for f in df.schema.fields) > WIDE_ROW


def _digest_columns(df: DataFrame) -> dict[str, Column]:
    columns = [F.col(c) for c in df.columns]
    return dict(zip(_DIGESTS, (F.xxhash64(*columns), F.xxhash64(F.lit(_DIGESTS[1]), *columns))))


def repeated_digests(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``df`` with a 128-bit digest of each row, and the stored digests of more than one row.

    Equal rows have equal digests (null equals null, NaN equals NaN); the reverse is
    left to whoever compares the rows of a repeated digest.
    """
    digested = df.withColumns(_digest_columns(df))
    counts = digested.groupBy(*_DIGESTS).agg(F.count("*").alias("_copies"))
    return digested, materialize(counts.where("_copies > 1").select(*_DIGESTS), "repeated")


def dedupe(df: DataFrame, digest_first: bool | None = None) -> DataFrame:
    """Drop exact duplicate rows; null equals null and NaN equals NaN.

    Copies are merged map-side before the shuffle, so a group of many copies reaches its
    reducer as one row per map task.  ``digest_first`` counts digests of the rows before,
    so that whole rows move only if their digest repeats, and are then compared in full;
    the others stay where they are.  It reads the table twice, which should thus be stored,
    and is the default for wide rows.  Where so many digests repeat that they cannot be
    broadcast, all rows are merged as usual.
    """
    if not (is_wide(df) if digest_first is None else digest_first):
        return df.dropDuplicates()
    digested, repeated = repeated_digests(df)
    if table_bytes(repeated) > BROADCAST_BYTES:
        return df.dropDuplicates()
    keys = F.broadcast(repeated)
    once = digested.join(keys, list(_DIGESTS), "left_anti").select(df.columns)
    several = digested.join(keys, list(_DIGESTS), "left_semi").select(df.columns)
    return once.unionByName(several.dropDuplicates())


def export_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the named columns; the scan reads only those."""
    return df.select(*columns)
