"""File writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions.missing import nan_to_null

_TIMES = (T.TimestampType, T.TimestampNTZType)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write CSV part files with a header row, one file per partition.

    A missing value (null or NaN) is an empty field, a time reads
    ``2024-01-31 13:00:00`` with its fraction if it has one, quotes inside text are
    doubled and blanks around text stay.
    """
    times = {
        f.name: F.col(f.name).cast("string")
        for f in df.schema.fields
        if isinstance(f.dataType, _TIMES)
    }
    out = nan_to_null(df)
    (out.withColumns(times) if times else out).write.mode(mode).options(
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
