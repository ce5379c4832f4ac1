"""Data-quality profile: shape, missing values, duplicates, summary, outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions.missing import is_missing, present
from wattloom.functions.order_stats import (
    CANDIDATE_LIMIT,
    approximate_quantiles,
    exact_quantiles,
    sketch,
)
from wattloom.operators.clean import is_wide, repeated_digests
from wattloom.operators.lookup_join import BROADCAST_BYTES, table_bytes

QUARTILES = [0.25, 0.5, 0.75]


def _per_column(df: DataFrame, columns: Sequence[str], measures: Mapping[str, dict]) -> DataFrame:
    """One row per column from a one-row aggregate with ``<measure>_<position>`` names."""
    rows = [
        F.struct(
            F.lit(name).alias("COLUMN_NAME"),
            *[F.col(f"{m}_{i}").alias(m) for m in measures],
        )
        for i, name in enumerate(columns)
    ]
    aggregated = df.agg(
        *[measures[m][name].alias(f"{m}_{i}") for m in measures for i, name in enumerate(columns)]
    )
    return aggregated.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def profile(df: DataFrame) -> DataFrame:
    """Position, name and type of every column, with the table's row and column counts."""
    spark = df.sparkSession
    layout = [
        (i, f.name, f.dataType.simpleString(), len(df.columns)) for i, f in enumerate(df.schema)
    ]
    columns = spark.createDataFrame(
        layout, "POSITION int, COLUMN_NAME string, DATA_TYPE string, COLUMN_COUNT int"
    )
    return columns.withColumn("ROW_COUNT", df.agg(F.count("*").alias("n")).scalar())


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values (null or NaN) per column, in one pass over the table."""
    columns = list(columns or df.columns)
    return _per_column(
        df, columns, {"MISSING": {c: F.count_if(is_missing(df, c)) for c in columns}}
    )


def duplicate_count(df: DataFrame, digest_first: bool | None = None) -> DataFrame:
    """Rows that repeat an earlier row: all but one of every group of equal rows.

    ``digest_first``, the default for wide rows, compares whole rows only where their
    digest repeats, as :func:`~wattloom.operators.clean.dedupe` does.
    """
    columns = df.columns
    if is_wide(df) if digest_first is None else digest_first:
        digested, repeated = repeated_digests(df)
        if table_bytes(repeated) <= BROADCAST_BYTES:
            df = digested.join(F.broadcast(repeated), repeated.columns, "left_semi").select(columns)
    groups = df.groupBy(*columns).agg(F.count("*").alias("_copies"))
    return groups.agg(
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("DUPLICATE_ROWS")
    )


def _literal_table(df: DataFrame, rows: list[tuple], ddl: str) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, ddl)


def quartiles(
    df: DataFrame,
    columns: Sequence[str],
    exact: bool = True,
    candidate_limit: int = CANDIDATE_LIMIT,
) -> DataFrame:
    """First and third quartile and their distance, per column."""
    found = _quantiles(df, columns, [0.25, 0.75], exact, candidate_limit)
    rows = []
    for c in columns:
        q1, q3 = found[(c, 0.25)], found[(c, 0.75)]
        rows.append((c, _number(q1), _number(q3), None if q1 is None else float(q3 - q1)))
    return _literal_table(df, rows, "COLUMN_NAME string, Q1 double, Q3 double, IQR double")


def _number(x) -> float | None:
    return None if x is None else float(x)


def _quantiles(df, columns, probabilities, exact, candidate_limit):
    if not exact:
        return approximate_quantiles(df, columns, probabilities)
    return exact_quantiles(df, columns, probabilities, candidate_limit=candidate_limit)


def iqr_bounds(
    df: DataFrame,
    columns: Sequence[str],
    k: float = 1.5,
    exact: bool = True,
    candidate_limit: int = CANDIDATE_LIMIT,
) -> dict[str, tuple[float, float] | None]:
    """Lower and upper fence of each column; None for a column without values."""
    found = _quantiles(df, columns, [0.25, 0.75], exact, candidate_limit)
    bounds = {}
    for c in columns:
        q1, q3 = found[(c, 0.25)], found[(c, 0.75)]
        bounds[c] = None if q1 is None else (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return bounds


def _outside(df: DataFrame, column: str, bounds: tuple[float, float] | None):
    if bounds is None:
        return F.lit(False)
    low, high = bounds
    value = present(df, column)
    return (value < F.lit(float(low))) | (value > F.lit(float(high)))


def iqr_outliers(df: DataFrame, column: str, k: float = 1.5, exact: bool = True) -> DataFrame:
    """Rows strictly outside the column's fences; the fences reach the scan as filters."""
    fences = iqr_bounds(df, [column], k, exact)[column]
    if fences is None:
        return df.limit(0)
    low, high = fences
    c = F.col(column)
    # NaN sorts above every number, so it passes the first test and needs the second.
    return df.where((c < F.lit(float(low))) | (c > F.lit(float(high)))).where(~is_missing(df, column))


def iqr_outlier_counts(
    df: DataFrame,
    columns: Sequence[str],
    k: float = 1.5,
    exact: bool = True,
    candidate_limit: int = CANDIDATE_LIMIT,
) -> DataFrame:
    """Outliers per column, all columns counted in one pass; no row is removed."""
    bounds = iqr_bounds(df, columns, k, exact, candidate_limit)
    return _per_column(
        df,
        columns,
        {"OUTLIERS": {c: F.count_if(_outside(df, c, bounds[c])) for c in columns}},
    )


def _ranges(moments, columns: Sequence[str]) -> dict[str, tuple]:
    return {
        c: (moments[f"n_{i}"], moments[f"min_{i}"], moments[f"max_{i}"])
        for i, c in enumerate(columns)
    }


def _sketches(moments, columns: Sequence[str]) -> dict:
    return {c: moments[f"sketch_{i}"] for i, c in enumerate(columns)}


def describe_columns(
    df: DataFrame,
    columns: Sequence[str],
    exact: bool = True,
    candidate_limit: int = CANDIDATE_LIMIT,
) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max per numeric column."""
    columns = list(columns)
    moments = df.agg(
        *[
            m.alias(f"{name}_{i}")
            for i, c in enumerate(columns)
            for name, m in {
                "n": F.count(present(df, c)),
                "mean": F.avg(present(df, c)),
                "std": F.stddev_samp(present(df, c)),
                "min": F.min(present(df, c)),
                "max": F.max(present(df, c)),
                **({"sketch": sketch(df, c, QUARTILES)} if exact else {}),
            }.items()
        ]
    ).first()
    if exact:
        ranges, sketches = _ranges(moments, columns), _sketches(moments, columns)
        q = exact_quantiles(df, columns, QUARTILES, ranges, candidate_limit, sketches)
    else:
        q = approximate_quantiles(df, columns, QUARTILES)
    rows = [
        (
            c,
            moments[f"n_{i}"],
            _number(moments[f"mean_{i}"]),
            _number(moments[f"std_{i}"]),
            _number(moments[f"min_{i}"]),
            *[_number(q[(c, p)]) for p in QUARTILES],
            _number(moments[f"max_{i}"]),
        )
        for i, c in enumerate(columns)
    ]
    return _literal_table(
        df,
        rows,
        "COLUMN_NAME string, N bigint, MEAN double, STD double, MIN double, "
        "Q25 double, Q50 double, Q75 double, MAX double",
    )


def describe_times(
    df: DataFrame,
    columns: Sequence[str],
    exact: bool = True,
    candidate_limit: int = CANDIDATE_LIMIT,
) -> DataFrame:
    """The same summary for timestamp columns, to the microsecond (no deviation)."""
    columns = list(columns)
    micros = df.select([F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in columns])
    moments = micros.agg(
        *[
            m.alias(f"{name}_{i}")
            for i, c in enumerate(columns)
            for name, m in {
                "n": F.count(c),
                "mean": F.avg(F.col(c).cast("decimal(20,0)")),
                "min": F.min(c),
                "max": F.max(c),
                **({"sketch": sketch(micros, c, QUARTILES)} if exact else {}),
            }.items()
        ]
    ).first()
    if exact:
        ranges, sketches = _ranges(moments, columns), _sketches(moments, columns)
        q = exact_quantiles(micros, columns, QUARTILES, ranges, candidate_limit, sketches)
    else:
        q = approximate_quantiles(micros, columns, QUARTILES)
    rows = [
        (
            c,
            moments[f"n_{i}"],
            *[
                _moment(x)
                for x in (
                    moments[f"mean_{i}"],
                    moments[f"min_{i}"],
                    *[q[(c, p)] for p in QUARTILES],
                    moments[f"max_{i}"],
                )
            ],
        )
        for i, c in enumerate(columns)
    ]
    names = ["MEAN", "MIN", "Q25", "Q50", "Q75", "MAX"]
    fields = [T.StructField("COLUMN_NAME", T.StringType()), T.StructField("N", T.LongType())]
    fields += [T.StructField(n, T.TimestampType()) for n in names]
    return df.sparkSession.createDataFrame(rows, T.StructType(fields))


def _moment(micros) -> datetime | None:
    if micros is None:
        return None
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    return epoch + timedelta(microseconds=int(micros))

