"""Every operator as a query over the given tables.

Averages are rounded to six digits here, because the last digits of a sum depend
on the order in which partitions are added; times are returned without a zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions.missing import complete_rows, present
from wattloom.functions.times import parse_mixed_timestamp
from wattloom.operators.clean import (
    clean_readings,
    dedupe,
    enforce_types,
    export_columns,
    validate_for_scoring,
)
from wattloom.operators.date_order import ambiguous_dates, date_order_evidence, parse_by_evidence
from wattloom.operators.metrics import regression_metrics
from wattloom.operators.model import (
    feature_importance,
    load_model,
    predictions_table,
    save_model,
    skipped_readings,
    train_power_model,
)
from wattloom.operators.prepare import (
    build_master,
    calendar_features,
    finalize_features,
    hourly_weather,
    label_encode,
    union_sources,
)
from wattloom.operators.profile import (
    describe_columns,
    describe_times,
    duplicate_count,
    iqr_outlier_counts,
    iqr_outliers,
    null_counts,
    profile,
    quartiles,
)
from wattloom.operators.reports import REPORTS
from wattloom.operators.split import time_split
from wattloom.operators.trees import forest_column
from wattloom.plans import jobs
from wattloom.plans.offline import feature_table, master_table, rejected_times
from wattloom.plans.telemetry import (
    as_records,
    encoded,
    event_stream,
    faulty_view,
    readings,
    table,
    telemetry_view,
)
from wattloom.plans.training import train_job
from wattloom.schema import (
    EXPORT_COLUMNS,
    FEATURES,
    GENERATION_SCHEMA,
    READING_SCHEMA,
    SCORED_SCHEMA,
    SENSOR_COLUMNS,
    STATISTICS,
    TARGET,
    WEATHER_MEASURES,
    WEATHER_SCHEMA,
    totals_schema,
    window_schema,
)
from wattloom.sinks.files import write_csv
from wattloom.sources.files import read_archive, read_csv, register_view, stream_files
from wattloom.sources.messages import decode_messages
from wattloom.streaming.rejects import LATEST, count_window_rejects, read_counts
from wattloom.streaming.sinks import BATCH_ID, read_batches, run_available, table_batch_sink
from wattloom.streaming.windows import running_totals, window_stats
from wattloom.workspace import materialize, new_path, shuffle_partitions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AVAILABLE_NOW = {"availableNow": True}
# Window and total states hold a few rows per window whatever the input size.
STATE_PARTITIONS = 8
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# Small enough that the narrowing rounds run on every scale of the test tables.
NARROW_LIMIT = 20
SMALL_FOREST = {"num_trees": 10, "max_depth": 5}


def query(name: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        return f

    return register


def _view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_view(table(spark, sf_dir, "events"))


def _faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return faulty_view(table(spark, sf_dir, "events"))


def _six(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), 6) for n in names})


def _zoneless(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            f.name: F.col(f.name).cast("timestamp_ntz")
            for f in df.schema.fields
            if isinstance(f.dataType, T.TimestampType)
        }
    )


def _report(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_view(spark, sf_dir))


for _number, (_name, _build) in enumerate(REPORTS.items(), start=1):
    QUERIES[f"q{_number:02d}_{_name}"] = _report(_build)


@query("view_sql")
def _view_sql(spark, sf_dir):
    register_view(readings(_faulty(spark, sf_dir)), "power_readings")
    return spark.sql(
        "SELECT PLANT_ID, COUNT(*) AS READINGS, MAX(AC_POWER) AS TOP_AC "
        "FROM power_readings GROUP BY PLANT_ID"
    )


# --- cleaning, types, messages ---


def _nan_flag(df: DataFrame, name: str) -> DataFrame:
    return df.withColumns(
        {f"{name}_IS_NAN": F.isnan(F.col(name)), name: present(df, name)}
    )


@query("clean_readings")
def _clean_readings_parity(spark, sf_dir):
    kept = clean_readings(_faulty(spark, sf_dir))
    return _zoneless(
        _nan_flag(
            kept.select("event_id", "DATE_TIME", "PLANT_ID", "POWER_GENERATED", "IRRADIATION"),
            "IRRADIATION",
        )
    )


@query("clean_readings_strict")
def _clean_readings_strict(spark, sf_dir):
    kept = clean_readings(_faulty(spark, sf_dir), nan_as_null=True)
    return _zoneless(
        kept.select("event_id", "DATE_TIME", "PLANT_ID", "POWER_GENERATED", "IRRADIATION")
    )


@query("validate_for_scoring")
def _valid_for_scoring(spark, sf_dir):
    kept = validate_for_scoring(_faulty(spark, sf_dir))
    return _nan_flag(
        _nan_flag(
            kept.select("event_id", "DATE_TIME", "PLANT_ID", "POWER_GENERATED", "IRRADIATION"),
            "IRRADIATION",
        ),
        "POWER_GENERATED",
    )


@query("enforce_types")
def _enforced_types(spark, sf_dir):
    view = _view(spark, sf_dir)
    bad = F.col("k") == 12
    text = view.select(
        "event_id",
        *[
            F.when(bad, F.lit("bad")).otherwise(F.col(c).cast("string")).alias(c)
            for c in READING_SCHEMA.fieldNames()
        ],
    )
    return enforce_types(text)


@query("export_projection")
def _export_projection(spark, sf_dir):
    return export_columns(_view(spark, sf_dir), EXPORT_COLUMNS)


@query("json_encode")
def _json_encode(spark, sf_dir):
    return encoded(_view(spark, sf_dir))


@query("json_decode")
def _json_decode(spark, sf_dir):
    records = as_records(_view(spark, sf_dir))
    return _zoneless(decode_messages(records))


@query("json_props")
def _json_props(spark, sf_dir):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    records = table(spark, sf_dir, "events").select(
        F.col("props").alias("value"), F.col("ts").alias("timestamp")
    )
    return decode_messages(records, schema, arrival="ts")


@query("parse_mixed_timestamp")
def _mixed_timestamps(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    t, status = F.col("o_orderdate").cast("timestamp"), F.col("o_orderstatus")
    text = (
        F.when(status == "F", F.date_format(t, "yyyy-MM-dd HH:mm:ss"))
        .when(status == "O", F.date_format(t, "MM-dd-yyyy HH:mm"))
        .otherwise(F.date_format(t, "dd-MM-yyyy HH:mm"))
    )
    return _zoneless(
        orders.select("o_orderkey", text.alias("TEXT")).withColumn(
            "DATE_TIME", parse_mixed_timestamp("TEXT")
        )
    )


def _dated_orders(spark, sf_dir) -> DataFrame:
    """Orders with a date as text; each priority is a source with an order of its own."""
    orders = table(spark, sf_dir, "orders")
    t, source = F.col("o_orderdate").cast("timestamp"), F.substring("o_orderpriority", 1, 1)
    month, day = F.date_format(t, "MM/dd/yyyy HH:mm"), F.date_format(t, "dd/MM/yyyy HH:mm")
    text = (
        F.when(source == "1", month)
        .when(source == "2", day)
        .when(source == "3", F.when(F.col("o_orderkey") % 2 == 0, month).otherwise(day))
        .when(source == "4", F.when(F.dayofmonth(t) <= 12, month))
        .otherwise(F.date_format(t, "yyyy-MM-dd HH:mm"))
    )
    return orders.select("o_orderkey", "o_orderpriority", text.alias("DATE_TIME"))


@query("date_order_evidence")
def _date_order_evidence(spark, sf_dir):
    return date_order_evidence(_dated_orders(spark, sf_dir), "DATE_TIME", ["o_orderpriority"])


@query("dates_by_evidence")
def _dates_by_evidence(spark, sf_dir):
    return _zoneless(parse_by_evidence(_dated_orders(spark, sf_dir), "DATE_TIME", ["o_orderpriority"]))


@query("ambiguous_dates")
def _ambiguous_dates(spark, sf_dir):
    return ambiguous_dates(_dated_orders(spark, sf_dir), "DATE_TIME", ["o_orderpriority"])


# --- preparation ---


@query("union_sources")
def _union_plants(spark, sf_dir):
    view = readings(_view(spark, sf_dir))
    middle = F.lit(4135004)
    return union_sources(
        view.where(F.col("PLANT_ID") <= middle),
        view.where(F.col("PLANT_ID") > middle).drop("TOTAL_YIELD"),
    )


def _generation(view: DataFrame) -> DataFrame:
    rows = view.where(F.col("event_type").isin("view", "click", "purchase"))
    return rows.withColumn("DATE_TIME", F.col("ts")).select(*GENERATION_SCHEMA.fieldNames())


def _weather(view: DataFrame) -> DataFrame:
    rows = view.where(F.col("event_type").isin("signup", "error"))
    return rows.withColumn("DATE_TIME", F.col("ts")).select(*WEATHER_SCHEMA.fieldNames())


@query("weather_hourly")
def _weather_hourly(spark, sf_dir):
    hourly = hourly_weather(_weather(_view(spark, sf_dir)))
    return _zoneless(_six(hourly, *WEATHER_MEASURES))


@query("master_join")
def _master_join(spark, sf_dir):
    view = _view(spark, sf_dir)
    master = build_master(_generation(view), hourly_weather(_weather(view)))
    return _zoneless(_six(master, *WEATHER_MEASURES))


@query("master_join_shuffled")
def _master_join_shuffled(spark, sf_dir):
    """The same join on the path taken when the weather is too large to broadcast."""
    view = _view(spark, sf_dir)
    master = build_master(
        _generation(view), hourly_weather(_weather(view)), broadcast_bytes=0, generation_stored=True
    )
    return _zoneless(_six(master, *WEATHER_MEASURES))


@query("calendar_features")
def _calendar(spark, sf_dir):
    view = _view(spark, sf_dir).select("event_id", F.col("ts").alias("DATE_TIME"))
    return _zoneless(calendar_features(view))


@query("finalize_features")
def _final_features(spark, sf_dir):
    view = _view(spark, sf_dir).select("event_id", F.col("ts").alias("DATE_TIME"), "AC_POWER")
    return _zoneless(finalize_features(view, F.col("AC_POWER") / 10.0))


@query("label_encode")
def _label_encode_source(spark, sf_dir):
    view = _view(spark, sf_dir).select("event_id", "SOURCE_KEY")
    return label_encode(view, "SOURCE_KEY")


@query("label_encode_shuffled")
def _label_encode_shuffled(spark, sf_dir):
    view = _view(spark, sf_dir).select("event_id", "SOURCE_KEY")
    return label_encode(view, "SOURCE_KEY", broadcast_bytes=0)


@query("label_encode_equal_rows")
def _label_encode_equal_rows(spark, sf_dir):
    """Rows of the key alone: half of them one key, a quarter without one."""
    at = F.col("event_id") % 4
    key = F.when(at < 2, F.lit("hot")).when(at == 3, F.col("SOURCE_KEY"))
    keys = _view(spark, sf_dir).select(key.alias("KEY"))
    return label_encode(keys, "KEY", broadcast_bytes=0)


@query("label_encode_brand")
def _label_encode_brand(spark, sf_dir):
    return label_encode(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_brand")


def _plant_files(view: DataFrame) -> tuple[DataFrame, DataFrame]:
    generation = view.where(F.col("event_type").isin("view", "click", "purchase")).select(
        *GENERATION_SCHEMA.fieldNames()
    )
    weather = view.where(F.col("event_type").isin("signup", "error")).select(
        *WEATHER_SCHEMA.fieldNames()
    )
    return generation, weather


@query("offline_features")
def _offline_features(spark, sf_dir):
    master = master_table(*_plant_files(_view(spark, sf_dir)))
    features = feature_table(master, F.col("AC_POWER") / 10.0)
    return _zoneless(_six(features, *WEATHER_MEASURES))


# Shapes of a time in raw files; the last is readable only where the day is no month.
TIME_SHAPES = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy/MM/dd HH:mm",
    "yyyyMMdd HH:mm",
    "dd-MMM-yyyy HH:mm",
    "MM/dd/yyyy hh:mm a",
    "MM.dd.yyyy HH:mm",
    "MM-dd-yyyy HH:mm:ss",
    "dd.MM.yyyy HH:mm",
]


@query("offline_features_mixed")
def _offline_features_mixed(spark, sf_dir):
    """The same features from times written in every shape."""
    view, t = _view(spark, sf_dir), F.col("ts")
    at = F.when(F.dayofmonth(t) > 12, F.col("event_id") % 8).otherwise(F.col("event_id") % 7)
    text = F.coalesce(*[F.when(at == i, F.date_format(t, s)) for i, s in enumerate(TIME_SHAPES)])
    master = master_table(*_plant_files(view.withColumn("DATE_TIME", text)))
    features = feature_table(master, F.col("AC_POWER") / 10.0)
    return _zoneless(_six(features, *WEATHER_MEASURES))


@query("rejected_rows")
def _rejected_rows(spark, sf_dir):
    rejects = rejected_times(readings(_faulty(spark, sf_dir)))
    return rejects.groupBy("COLUMN_NAME", "TEXT", "REASON").agg(F.count("*").alias("ROWS_REJECTED"))


# --- profile ---


def _stored_sensors(spark, sf_dir) -> DataFrame:
    """Stored once: the rank search reads its columns several times."""
    return materialize(_faulty(spark, sf_dir).select(*SENSOR_COLUMNS), "sensors")


def _line_keys(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")


@query("dedupe")
def _dedupe_lines(spark, sf_dir):
    return dedupe(_line_keys(spark, sf_dir))


@query("duplicate_count")
def _duplicate_lines(spark, sf_dir):
    return duplicate_count(_line_keys(spark, sf_dir))


def _wide_lines(spark, sf_dir) -> DataFrame:
    """All columns of the lines, some lines two or three times."""
    lines = table(spark, sf_dir, "lineitem")
    again = lines.where(F.col("l_orderkey") % 5 == 0)
    return lines.unionAll(again).unionAll(again.where(F.col("l_linenumber") == 1))


@query("dedupe_wide")
def _dedupe_wide(spark, sf_dir):
    """Whole lines, most of which are alone and never move."""
    return dedupe(_wide_lines(spark, sf_dir)).select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


@query("duplicate_count_wide")
def _duplicate_count_wide(spark, sf_dir):
    return duplicate_count(_wide_lines(spark, sf_dir))


@query("null_counts")
def _missing_counts(spark, sf_dir):
    return null_counts(readings(_faulty(spark, sf_dir)))


@query("profile")
def _table_profile(spark, sf_dir):
    return profile(readings(_view(spark, sf_dir)))


@query("describe_columns")
def _describe_lines(spark, sf_dir):
    summary = describe_columns(table(spark, sf_dir, "lineitem"), LINE_NUMBERS)
    return _six(summary, "MEAN", "STD", "MIN", "Q25", "Q50", "Q75", "MAX")


@query("describe_readings")
def _describe_readings(spark, sf_dir):
    summary = describe_columns(
        _stored_sensors(spark, sf_dir), SENSOR_COLUMNS, candidate_limit=NARROW_LIMIT
    )
    return _six(summary, "MEAN", "STD", "MIN", "Q25", "Q50", "Q75", "MAX")


@query("describe_times")
def _describe_event_times(spark, sf_dir):
    return _zoneless(describe_times(table(spark, sf_dir, "events"), ["ts"]))


@query("quartiles")
def _quartiles_lines(spark, sf_dir):
    return _six(quartiles(table(spark, sf_dir, "lineitem"), LINE_NUMBERS), "Q1", "Q3", "IQR")


@query("quartiles_narrowed")
def _quartiles_narrowed(spark, sf_dir):
    """The same quartiles with the rank search forced through its narrowing rounds."""
    found = quartiles(
        table(spark, sf_dir, "lineitem"), LINE_NUMBERS, candidate_limit=NARROW_LIMIT
    )
    return _six(found, "Q1", "Q3", "IQR")


@query("iqr_outlier_counts")
def _outlier_counts(spark, sf_dir):
    return iqr_outlier_counts(_stored_sensors(spark, sf_dir), SENSOR_COLUMNS)


@query("iqr_outliers")
def _outlier_rows(spark, sf_dir):
    return iqr_outliers(table(spark, sf_dir, "events").select("event_id", "value"), "value")


# --- windows, totals, streams ---


def _closed_stats(stored: DataFrame) -> DataFrame:
    return _zoneless(_six(stored.drop(BATCH_ID), *STATISTICS))


@query("window_batch")
def _window_batch(spark, sf_dir):
    records = as_records(_faulty(spark, sf_dir))
    clean = clean_readings(decode_messages(records, jobs.STATISTICS_FIELDS), nan_as_null=True)
    return _zoneless(_six(window_stats(clean, size="1 hour"), *STATISTICS))


def _stream_windows(spark, sf_dir, size: str, count_name: str) -> DataFrame:
    records = as_records(faulty_view(event_stream(spark, sf_dir)))
    out, checkpoint = new_path(spark, "windows"), new_path(spark, "windows-checkpoint")
    with shuffle_partitions(spark, STATE_PARTITIONS):
        run_available(
            jobs.window_job(
                records,
                table_batch_sink(out),
                checkpoint,
                size=size,
                count_name=count_name,
                nan_as_null=True,
                trigger=AVAILABLE_NOW,
            )
        )
    return _closed_stats(read_batches(spark, out, window_schema(count_name)))


@query("stream_window_clean")
def _stream_window_clean(spark, sf_dir):
    return _stream_windows(spark, sf_dir, "1 hour", "CLEAN_RECORDS")


@query("stream_window_10s")
def _stream_window_10s(spark, sf_dir):
    return _stream_windows(spark, sf_dir, "10 seconds", "TOTAL_RECORDS")


@query("stream_late_data")
def _stream_late_data(spark, sf_dir):
    """Three restarts of one query; the last brings rows whose windows have closed."""
    out, checkpoint = new_path(spark, "late"), new_path(spark, "late-checkpoint")
    _with_late_rows(
        spark,
        sf_dir,
        lambda events: jobs.window_job(
            as_records(telemetry_view(events)),
            table_batch_sink(out),
            checkpoint,
            size="1 hour",
            trigger=AVAILABLE_NOW,
        ),
    )
    return _closed_stats(read_batches(spark, out, window_schema()))


def _with_late_rows(spark, sf_dir, start) -> None:
    """Run a stream job over the events in three restarts; the first third's signups come last."""
    events = table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    ends = events.agg(F.min(micros).alias("first"), F.max(micros).alias("last")).first()
    third = (ends["last"] - ends["first"]) // 3
    one, two = ends["first"] + third, ends["first"] + 2 * third
    held_back = (micros < one) & (F.col("event_type") == "signup")
    arrivals = [
        (micros < one) & ~held_back,
        (micros >= one) & (micros < two),
        (micros >= two) | held_back,
    ]
    inbox = new_path(spark, "late-inbox")
    for arrived in arrivals:
        events.where(arrived).write.mode("append").parquet(inbox)
        stream = stream_files(spark, inbox, events.schema)
        with shuffle_partitions(spark, STATE_PARTITIONS):
            run_available(start(stream))


@query("stream_rejects")
def _stream_rejects(spark, sf_dir):
    """What the hourly statistics leave out, batch by batch and by reason."""
    out, checkpoint = new_path(spark, "rejects"), new_path(spark, "rejects-checkpoint")
    _with_late_rows(
        spark,
        sf_dir,
        lambda events: count_window_rejects(
            decode_messages(as_records(faulty_view(events)), jobs.STATISTICS_FIELDS),
            out,
            checkpoint,
            size="1 hour",
            nan_as_null=True,
            trigger=AVAILABLE_NOW,
        ),
    )
    return read_counts(spark, out).drop(LATEST)


@query("totals_batch")
def _totals_batch(spark, sf_dir):
    clean = clean_readings(_faulty(spark, sf_dir), nan_as_null=True)
    return _six(running_totals(clean), *STATISTICS)


@query("stream_running_totals")
def _stream_running_totals(spark, sf_dir):
    records = as_records(faulty_view(event_stream(spark, sf_dir)))
    out, checkpoint = new_path(spark, "totals"), new_path(spark, "totals-checkpoint")
    with shuffle_partitions(spark, STATE_PARTITIONS):
        run_available(
            jobs.totals_job(
                records,
                table_batch_sink(out),
                checkpoint,
                nan_as_null=True,
                trigger=AVAILABLE_NOW,
            )
        )
    snapshots = read_batches(spark, out, totals_schema())
    latest = snapshots.agg(F.max(BATCH_ID)).scalar()
    return _six(snapshots.where(F.col(BATCH_ID) == latest).drop(BATCH_ID), *STATISTICS)


@query("stream_archive")
def _stream_archive(spark, sf_dir):
    records = as_records(telemetry_view(event_stream(spark, sf_dir)))
    out, checkpoint = new_path(spark, "archive"), new_path(spark, "archive-checkpoint")
    run_available(jobs.archive_job(records, out, checkpoint, AVAILABLE_NOW))
    return read_archive(spark, out)


def _in_quarters(spark, sf_dir, label: str, start) -> None:
    """Run a stream job over the events in four restarts, each with the next quarter of time."""
    events = table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    ends = events.agg(F.min(micros).alias("first"), F.max(micros).alias("last")).first()
    width = (ends["last"] - ends["first"]) // 4 + 1
    inbox = new_path(spark, label)
    for quarter in range(4):
        arrived = F.floor((micros - F.lit(ends["first"])) / F.lit(width)) == quarter
        events.where(arrived).write.mode("append").parquet(inbox)
        stream = stream_files(spark, inbox, events.schema)
        with shuffle_partitions(spark, STATE_PARTITIONS):
            run_available(start(stream))


@query("stream_window_quarters")
def _stream_window_quarters(spark, sf_dir):
    """Hourly windows whose state passes through several micro-batches and restarts."""
    out, checkpoint = new_path(spark, "windows"), new_path(spark, "windows-checkpoint")
    _in_quarters(
        spark,
        sf_dir,
        "windows-inbox",
        lambda events: jobs.window_job(
            as_records(faulty_view(events)),
            table_batch_sink(out),
            checkpoint,
            size="1 hour",
            count_name="CLEAN_RECORDS",
            nan_as_null=True,
            trigger=AVAILABLE_NOW,
        ),
    )
    return _closed_stats(read_batches(spark, out, window_schema("CLEAN_RECORDS")))


@query("stream_totals_quarters")
def _stream_totals_quarters(spark, sf_dir):
    """Totals after the last of several micro-batches, with the number of snapshots."""
    out, checkpoint = new_path(spark, "totals"), new_path(spark, "totals-checkpoint")
    _in_quarters(
        spark,
        sf_dir,
        "totals-inbox",
        lambda events: jobs.totals_job(
            as_records(faulty_view(events)),
            table_batch_sink(out),
            checkpoint,
            nan_as_null=True,
            trigger=AVAILABLE_NOW,
        ),
    )
    snapshots = read_batches(spark, out, totals_schema())
    latest = snapshots.agg(F.max(BATCH_ID)).scalar()
    last = _six(snapshots.where(F.col(BATCH_ID) == latest).drop(BATCH_ID), *STATISTICS)
    return last.withColumn("SNAPSHOTS", snapshots.agg(F.count_distinct(BATCH_ID)).scalar())


@query("stream_archive_quarters")
def _stream_archive_quarters(spark, sf_dir):
    out, checkpoint = new_path(spark, "archive"), new_path(spark, "archive-checkpoint")
    _in_quarters(
        spark,
        sf_dir,
        "archive-inbox",
        lambda events: jobs.archive_job(
            as_records(telemetry_view(events)), out, checkpoint, AVAILABLE_NOW
        ),
    )
    return read_archive(spark, out)


@query("csv_roundtrip")
def _csv_roundtrip(spark, sf_dir):
    path = new_path(spark, "csv")
    write_csv(readings(_view(spark, sf_dir)), path)
    return read_csv(spark, path, READING_SCHEMA)


@query("csv_line_breaks")
def _csv_line_breaks(spark, sf_dir):
    """Text with line breaks, quotes and commas written to CSV and read back."""
    path = new_path(spark, "csv")
    text = F.concat(F.col("SOURCE_KEY"), F.lit('\n"a", '), F.col("PLANT_ID"))
    write_csv(readings(_view(spark, sf_dir)).withColumn("SOURCE_KEY", text), path)
    return read_csv(spark, path, READING_SCHEMA, line_breaks=True)


# --- model ---


TIES = ["PLANT_ID", "SOURCE_KEY", "event_id"]


def _labelled(spark, sf_dir) -> DataFrame:
    view = _faulty(spark, sf_dir).withColumn("DATE_TIME", F.col("ts"))
    return view.select("DATE_TIME", *TIES, *FEATURES, TARGET)


def _training_rows(spark, sf_dir) -> DataFrame:
    """Stored once: the split, the fit and the scoring each read these rows."""
    return materialize(_labelled(spark, sf_dir), "training")


def _split(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return time_split(
        _training_rows(spark, sf_dir), "DATE_TIME", TIES, complete=[*FEATURES, TARGET]
    )


@query("ml_split")
def _ml_split(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    keep = ["event_id", "DATE_TIME", "PLANT_ID", "SOURCE_KEY", TARGET]
    return _zoneless(
        train.select(*keep, F.lit("train").alias("PART")).unionByName(
            test.select(*keep, F.lit("test").alias("PART"))
        )
    )


@query("ml_split_ties")
def _ml_split_ties(spark, sf_dir):
    """Split on the calendar day, so that a whole day of rows ties at the cut."""
    days = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    months = days.withColumn("MONTH_START", F.date_trunc("month", F.col("o_orderdate").cast("timestamp")))
    train, test = time_split(
        months, "MONTH_START", ["o_orderpriority", "o_orderkey"], candidate_limit=NARROW_LIMIT
    )
    keep = ["o_orderkey", "MONTH_START"]
    return _zoneless(
        train.select(*keep, F.lit("train").alias("PART")).unionByName(
            test.select(*keep, F.lit("test").alias("PART"))
        )
    )


@query("regression_metrics")
def _metrics_formula(spark, sf_dir):
    guess = F.col(TARGET) * 0.9 + F.col("AMBIENT_TEMPERATURE") / 10.0
    scored = _view(spark, sf_dir).select(
        F.col(TARGET).alias("ACTUAL_POWER"), guess.alias("PREDICTED_POWER")
    )
    return _six(regression_metrics(scored), "MAE", "RMSE", "R2")


def _stored_model(spark, train: DataFrame) -> PipelineModel:
    path = new_path(spark, "model")
    save_model(train_power_model(train, **SMALL_FOREST), path)
    return load_model(path)


@query("ml_predictions")
def _ml_predictions(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    return _zoneless(predictions_table(_stored_model(spark, train), test))


@query("ml_metrics")
def _ml_metrics(spark, sf_dir):
    trained = train_job(
        _labelled(spark, sf_dir), new_path(spark, "model"), tie_columns=TIES, **SMALL_FOREST
    )
    return trained.metrics


@query("ml_prediction_rows")
def _ml_prediction_rows(spark, sf_dir):
    """Which rows are predicted, and that each has a prediction."""
    train, test = _split(spark, sf_dir)
    found = predictions_table(_stored_model(spark, train), test)
    return _zoneless(
        found.withColumn("HAS_PREDICTION", F.col("PREDICTED_POWER").isNotNull()).drop(
            "PREDICTED_POWER"
        )
    )


@query("ml_expression")
def _ml_expression(spark, sf_dir):
    """The test rows, and whether the forest written out as an expression predicts the same values."""
    train, test = _split(spark, sf_dir)
    model = _stored_model(spark, train)
    scored = model.transform(test.withColumn("WRITTEN_OUT", forest_column(model)))
    return _zoneless(
        scored.select(
            "DATE_TIME",
            "PLANT_ID",
            "SOURCE_KEY",
            F.col(TARGET).alias("ACTUAL_POWER"),
            F.col("WRITTEN_OUT").eqNullSafe(F.col("PREDICTED_POWER")).alias("HAS_PREDICTION"),
        )
    )


# One cut over columns of few values, on all rows: SQL can find the same one.
STUMP_FEATURES = ["HOUR", "DAY_OF_WEEK"]
STUMP = {"num_trees": 1, "max_depth": 1, "bootstrap": False}


def _stump(spark, sf_dir) -> tuple[PipelineModel, DataFrame]:
    rows = complete_rows(_training_rows(spark, sf_dir), [*FEATURES, TARGET])
    return train_power_model(rows, STUMP_FEATURES, **STUMP), rows


@query("ml_stump")
def _ml_stump(spark, sf_dir):
    """Predictions of a tree of one cut."""
    return _zoneless(_six(predictions_table(*_stump(spark, sf_dir)), "PREDICTED_POWER"))


@query("ml_stump_metrics")
def _ml_stump_metrics(spark, sf_dir):
    found = regression_metrics(predictions_table(*_stump(spark, sf_dir)))
    return _six(found, "MAE", "RMSE", "R2")


@query("ml_importance_stump")
def _ml_importance_stump(spark, sf_dir):
    return feature_importance(_stump(spark, sf_dir)[0])


@query("ml_importance")
def _ml_importance(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    return feature_importance(_stored_model(spark, train))


def _score_the_stream(spark, sf_dir) -> DataFrame:
    train, _ = _split(spark, sf_dir)
    model = _stored_model(spark, train)
    records = as_records(faulty_view(event_stream(spark, sf_dir)))
    out, checkpoint = new_path(spark, "scored"), new_path(spark, "scored-checkpoint")
    run_available(
        jobs.scoring_job(records, model, table_batch_sink(out), checkpoint, AVAILABLE_NOW)
    )
    return read_batches(spark, out, SCORED_SCHEMA).drop(BATCH_ID)


@query("ml_stream_score")
def _ml_stream_score(spark, sf_dir):
    return _zoneless(_score_the_stream(spark, sf_dir))


@query("scoring_rejects")
def _scoring_rejects(spark, sf_dir):
    """How many decoded readings the scoring leaves out, and why."""
    decoded = decode_messages(as_records(_faulty(spark, sf_dir)), arrival=None)
    return skipped_readings(decoded).groupBy("REASON").agg(F.count("*").alias("ROWS_SKIPPED"))


@query("ml_stream_rows")
def _ml_stream_rows(spark, sf_dir):
    """Which rows the scoring stream keeps, and that each has a prediction."""
    scored = _score_the_stream(spark, sf_dir)
    return _zoneless(
        scored.select(
            "EVENT_TIME",
            "PLANT_ID",
            "SOURCE_KEY",
            present(scored, "ACTUAL_POWER").alias("ACTUAL_POWER"),
            "IRRADIATION",
            F.col("PREDICTED_POWER").isNotNull().alias("HAS_PREDICTION"),
        )
    )
