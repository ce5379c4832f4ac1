"""Fixed table layouts and column lists shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: names, order and types are part of the data contract. ---

READING_SCHEMA = T.StructType(
    [
        T.StructField("DATE_TIME", T.StringType()),
        T.StructField("PLANT_ID", T.IntegerType()),
        T.StructField("SOURCE_KEY", T.StringType()),
        T.StructField("DC_POWER", T.DoubleType()),
        T.StructField("AC_POWER", T.DoubleType()),
        T.StructField("DAILY_YIELD", T.DoubleType()),
        T.StructField("TOTAL_YIELD", T.DoubleType()),
        T.StructField("AMBIENT_TEMPERATURE", T.DoubleType()),
        T.StructField("MODULE_TEMPERATURE", T.DoubleType()),
        T.StructField("IRRADIATION", T.DoubleType()),
        T.StructField("YEAR", T.IntegerType()),
        T.StructField("MONTH", T.IntegerType()),
        T.StructField("DAY", T.IntegerType()),
        T.StructField("HOUR", T.IntegerType()),
        T.StructField("DAY_OF_WEEK", T.IntegerType()),
        T.StructField("POWER_GENERATED", T.DoubleType()),
    ]
)

GENERATION_SCHEMA = T.StructType(
    [
        T.StructField("DATE_TIME", T.StringType()),
        T.StructField("PLANT_ID", T.IntegerType()),
        T.StructField("SOURCE_KEY", T.StringType()),
        T.StructField("DC_POWER", T.DoubleType()),
        T.StructField("AC_POWER", T.DoubleType()),
        T.StructField("DAILY_YIELD", T.DoubleType()),
        T.StructField("TOTAL_YIELD", T.DoubleType()),
    ]
)

WEATHER_SCHEMA = T.StructType(
    [
        T.StructField("DATE_TIME", T.StringType()),
        T.StructField("PLANT_ID", T.IntegerType()),
        T.StructField("SOURCE_KEY", T.StringType()),
        T.StructField("AMBIENT_TEMPERATURE", T.DoubleType()),
        T.StructField("MODULE_TEMPERATURE", T.DoubleType()),
        T.StructField("IRRADIATION", T.DoubleType()),
    ]
)

TARGET = "POWER_GENERATED"

WEATHER_MEASURES = ["AMBIENT_TEMPERATURE", "MODULE_TEMPERATURE", "IRRADIATION"]

SENSOR_COLUMNS = [
    "DC_POWER",
    "AC_POWER",
    "DAILY_YIELD",
    "TOTAL_YIELD",
    *WEATHER_MEASURES,
]

FEATURES = [*SENSOR_COLUMNS, "YEAR", "MONTH", "DAY", "HOUR", "DAY_OF_WEEK"]

EXPORT_COLUMNS = [
    "DATE_TIME",
    "PLANT_ID",
    "POWER_GENERATED",
    "AMBIENT_TEMPERATURE",
    "IRRADIATION",
]

REQUIRED_COLUMNS = ["DATE_TIME", "PLANT_ID", "POWER_GENERATED"]

NON_NEGATIVE_COLUMNS = ["POWER_GENERATED", "IRRADIATION"]

SCORING_REQUIRED = [
    "DATE_TIME",
    "PLANT_ID",
    "AC_POWER",
    "DC_POWER",
    "IRRADIATION",
    "POWER_GENERATED",
]

STATISTICS = ["AVG_POWER", "MAX_POWER", "MIN_POWER", "AVG_IRRADIATION"]


def window_schema(count_name: str = "TOTAL_RECORDS") -> T.StructType:
    """Layout of window statistics."""
    bounds = [T.StructField(n, T.TimestampType()) for n in ("WINDOW_START", "WINDOW_END")]
    return T.StructType([*bounds, *totals_schema(count_name).fields])


def totals_schema(count_name: str = "TOTAL_RECORDS") -> T.StructType:
    """Layout of running totals."""
    counted = T.StructField(count_name, T.LongType())
    return T.StructType([counted, *(T.StructField(n, T.DoubleType()) for n in STATISTICS)])


SCORED_SCHEMA = T.StructType(
    [
        T.StructField("EVENT_TIME", T.TimestampType()),
        T.StructField("PREDICTION_TIME", T.TimestampType()),
        T.StructField("PLANT_ID", T.IntegerType()),
        T.StructField("SOURCE_KEY", T.StringType()),
        T.StructField("ACTUAL_POWER", T.DoubleType()),
        T.StructField("PREDICTED_POWER", T.DoubleType()),
        T.StructField("IRRADIATION", T.DoubleType()),
    ]
)

EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Tokens that the usual CSV readers of data-frame libraries take as "missing".
MISSING_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]
