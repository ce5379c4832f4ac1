"""The 16-column readings table, seen through the ``events`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.schema import READING_SCHEMA
from wattloom.sources.files import stream_files
from wattloom.sources.messages import encode_messages

# How an event becomes a reading.
FIRST_PLANT = 4135001
PLANTS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_stream(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """The ``events`` files as a stream."""
    schema = table(spark, sf_dir, "events").schema
    # A glob, because the file source takes a folder or a glob but no single file.
    return stream_files(spark, f"{sf_dir}/events.parque[t]", schema, **options)


def _with_bucket(events: DataFrame) -> DataFrame:
    """``k`` from the event's properties, extracted once per row whatever uses it."""
    parsed = F.from_json("props", "k int")
    return events.select("*", F.inline_outer(F.array(parsed)))


def telemetry_view(events: DataFrame) -> DataFrame:
    """Readings built from events; ``event_id``, ``event_type``, ``ts`` and ``k`` ride along."""
    t = F.col("ts").cast("timestamp")
    k = F.col("k").cast("double")
    value = F.col("value")
    if "k" not in events.columns:
        # A plain expression, so that reports without k do not read the properties.
        events = events.withColumn("k", F.get_json_object("props", "$.k").try_cast("int"))
    return events.select(
        "event_id",
        "event_type",
        t.alias("ts"),
        "k",
        F.date_format(t, "yyyy-MM-dd HH:mm:ss").alias("DATE_TIME"),
        (F.col("user_id") % PLANTS + FIRST_PLANT).cast("int").alias("PLANT_ID"),
        F.concat(F.lit("INV-"), F.col("user_id").cast("string")).alias("SOURCE_KEY"),
        (value * 10.0).alias("DC_POWER"),
        (value * 9.5).alias("AC_POWER"),
        (value * (F.hour(t) + 1)).alias("DAILY_YIELD"),
        (F.col("event_id") + F.lit(1000000.0)).alias("TOTAL_YIELD"),
        (k * 0.15 + 20.0).alias("AMBIENT_TEMPERATURE"),
        (k * 0.25 + 25.0).alias("MODULE_TEMPERATURE"),
        (k / 80.0).alias("IRRADIATION"),
        F.year(t).alias("YEAR"),
        F.month(t).alias("MONTH"),
        F.dayofmonth(t).alias("DAY"),
        F.hour(t).alias("HOUR"),
        F.weekday(t).alias("DAY_OF_WEEK"),
        value.alias("POWER_GENERATED"),
    )


def faulty_view(events: DataFrame) -> DataFrame:
    """The same readings with faults: each fault hits the events of one ``k`` value."""
    k = F.col("k")
    nan = F.lit(float("nan"))

    def broken(name: str, *cases) -> Column:
        c = F.col(name)
        for at, value in cases:
            c = F.when(k == at, value).otherwise(c)
        return c

    return telemetry_view(_with_bucket(events)).withColumns(
        {
            "PLANT_ID": broken("PLANT_ID", (0, F.lit(None))),
            "POWER_GENERATED": broken(
                "POWER_GENERATED", (1, F.lit(None)), (2, nan), (5, -F.col("POWER_GENERATED"))
            ),
            "IRRADIATION": broken("IRRADIATION", (3, F.lit(None)), (4, nan), (6, F.lit(-0.5))),
            "DATE_TIME": broken("DATE_TIME", (7, F.lit("n/a")), (8, F.lit(None))),
            "AC_POWER": broken("AC_POWER", (9, F.lit(None))),
            "DC_POWER": broken("DC_POWER", (10, nan)),
        }
    )


def readings(view: DataFrame) -> DataFrame:
    """Only the 16 reading columns."""
    return view.select(*READING_SCHEMA.fieldNames())


def as_records(view: DataFrame) -> DataFrame:
    """Readings as topic records: JSON bytes and arrival time; ``k = 11`` is cut short."""
    text = F.to_json(F.struct(*READING_SCHEMA.fieldNames()), {"ignoreNullFields": "false"})
    value = F.when(F.col("k") == 11, F.lit('{"DATE_TIME": "2024-')).otherwise(text)
    return view.select("event_id", value.cast("binary").alias("value"), F.col("ts").alias("timestamp"))


def encoded(view: DataFrame) -> DataFrame:
    """Readings as JSON text."""
    return encode_messages(readings(view))
