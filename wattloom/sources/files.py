"""CSV and Parquet scans, and SQL views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.schema import MISSING_TOKENS, READING_SCHEMA
from wattloom.sinks.archive import read_batches_of_archive


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_CORRUPT = "_corrupt_record"


def _csv_text(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    line_breaks: bool,
    corrupt: bool = False,
) -> DataFrame:
    """All fields as text; ``corrupt`` adds the records that do not have as many fields."""
    fields = [T.StructField(f.name, T.StringType()) for f in schema.fields]
    if corrupt:
        fields.append(T.StructField(_CORRUPT, T.StringType()))
    return (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", line_breaks)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .csv([paths] if isinstance(paths, str) else list(paths))
    )


def _value(name: str, kind: T.DataType, tokens: Sequence[str]) -> Column:
    text = F.when(~F.col(name).isin(list(tokens)), F.col(name))
    if isinstance(kind, _WHOLE):
        # Data-frame libraries write whole numbers of a column with gaps as 17.0.
        text = F.regexp_replace(text, r"^(\s*[+-]?\d+)\.0*(\s*)$", "$1$2")
    return text.try_cast(kind)


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    missing_tokens: Sequence[str] = MISSING_TOKENS,
    line_breaks: bool = False,
) -> DataFrame:
    """Read CSV files with a header row under a declared schema.

    Fields equal to one of ``missing_tokens`` become null, and so do values the
    declared type cannot hold, which :func:`csv_rejects` lists; ``17.0`` is a whole
    number.  ``line_breaks`` allows them inside quoted fields; a file is then one
    task, since it cannot be cut.  A file whose header does not match the schema is an
    error.  No pass over the data is spent on inferring types.
    """
    text = _csv_text(spark, paths, schema, line_breaks)
    return text.select([_value(f.name, f.dataType, missing_tokens).alias(f.name) for f in schema.fields])


def csv_rejects(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    missing_tokens: Sequence[str] = MISSING_TOKENS,
    line_breaks: bool = False,
) -> DataFrame:
    """``COLUMN_NAME, TEXT, REASON``: one row per field that :func:`read_csv` loses.

    A record with too few or too many fields is one row, without a column name.
    """
    text = _csv_text(spark, paths, schema, line_breaks, corrupt=True)
    entry = lambda name, value, reason: F.struct(
        F.lit(name).cast("string").alias("COLUMN_NAME"),
        value.alias("TEXT"),
        F.lit(reason).alias("REASON"),
    )
    fields = [
        F.when(
            F.col(f.name).isNotNull()
            & ~F.col(f.name).isin(list(missing_tokens))
            & _value(f.name, f.dataType, missing_tokens).isNull(),
            entry(f.name, F.col(f.name), f"no {f.dataType.simpleString()}"),
        )
        for f in schema.fields
    ]
    record = F.when(
        F.col(_CORRUPT).isNotNull(), entry(None, F.col(_CORRUPT), "wrong number of fields")
    )
    return (
        text.select(F.explode(F.array(record, *fields)).alias("r"))
        .where("r IS NOT NULL")
        .select("r.*")
    )


def read_archive(
    spark: SparkSession, path: str, schema: T.StructType | None = READING_SCHEMA
) -> DataFrame:
    """Scan a Parquet archive; ``schema=None`` takes the layout from the files.

    If it was written batch by batch, only complete batches are read.
    """
    frame = read_batches_of_archive(spark, path, schema)
    if frame is None:
        reader = spark.read if schema is None else spark.read.schema(schema)
        frame = reader.parquet(path)
    # Partition columns come back last; restore the declared order.
    return frame if schema is None else frame.select(*schema.fieldNames())


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    **options,
) -> DataFrame:
    """A folder (or glob) of files as a stream; new files are new rows."""
    return spark.readStream.schema(schema).options(**options).format(fmt).load(path)


def register_view(df: DataFrame, name: str) -> None:
    """Make the table available to ``spark.sql`` under ``name``."""
    df.createOrReplaceTempView(name)
