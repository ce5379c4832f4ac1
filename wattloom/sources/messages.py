"""JSON messages: rows to record values and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions.missing import nan_to_null
from wattloom.schema import READING_SCHEMA

ARRIVAL = "STREAM_TIMESTAMP"


def encode_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """One JSON object per row, every column present (missing ones as ``null``)."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(value))


def decode_messages(
    records: DataFrame,
    schema: T.StructType = READING_SCHEMA,
    arrival: str | None = ARRIVAL,
    nan_as_null: bool = False,
) -> DataFrame:
    """Flatten the JSON ``value`` of each record into typed columns.

    Text that is not JSON gives a row of nulls; one bad field gives one null.  The
    record's ``timestamp`` is carried along as ``arrival`` unless that is None.
    ``NaN`` tokens stay NaN unless ``nan_as_null``.
    """
    carried = [F.col("timestamp").alias(arrival)] if arrival else []
    data = F.from_json(F.col("value").cast("string"), schema)
    # inline() keeps later filters above the parser.  With a plain struct they are
    # pushed below it, and every field they name parses the message once more.
    flat = records.select(*carried, F.inline_outer(F.array(data)))
    return nan_to_null(flat) if nan_as_null else flat
