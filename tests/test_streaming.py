import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattloom.operators.model import train_power_model
from wattloom.plans import jobs
from wattloom.plans.telemetry import readings, table, telemetry_view
from wattloom.schema import FEATURES
from wattloom.sources.files import read_archive, stream_files
from wattloom.sources.messages import decode_messages
from wattloom.streaming.sinks import (
    BATCH_ID,
    archive_stream,
    read_batches,
    run_available,
    start_batches,
    table_batch_sink,
)
from wattloom.streaming.windows import running_totals, window_stats

NOW = {"availableNow": True}
T0 = datetime(2024, 1, 1)
RECORDS = "value string, timestamp timestamp"


def message(power=1.0, irradiation=1.0, **changes):
    fields = {"DATE_TIME": "2024-01-01 00:00:00", "PLANT_ID": 1, "SOURCE_KEY": "k"}
    fields.update(dict.fromkeys(FEATURES, 1))
    fields.update(YEAR=2024, MONTH=1, DAY=1)
    fields.update(POWER_GENERATED=power, IRRADIATION=irradiation, **changes)
    return json.dumps(fields)


class Topic:
    """A folder that plays the topic: each ``send`` adds one file of records."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path)

    def send(self, *records):
        rows = [(m, T0 + timedelta(seconds=s)) for s, m in records]
        frame = self.spark.createDataFrame(rows, RECORDS).coalesce(1)
        frame.write.mode("append").parquet(self.path)

    def records(self, **options):
        schema = self.spark.createDataFrame([], RECORDS).schema
        return stream_files(self.spark, self.path, schema, **options)


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


@pytest.fixture
def out(tmp_path):
    return str(tmp_path / "out")


@pytest.fixture
def checkpoint(tmp_path):
    return str(tmp_path / "checkpoint")


def windows(spark, out):
    rows = read_batches(spark, out, window_stats(sample(spark)).schema).collect()
    return sorted(((r["WINDOW_START"] - T0).seconds, r["TOTAL_RECORDS"]) for r in rows)


def sample(spark):
    return decode_messages(spark.createDataFrame([(message(), T0)], RECORDS))


def test_windows_close_after_the_delay_and_late_rows_drop(spark, topic, out, checkpoint):
    def run():
        run_available(jobs.window_job(topic.records(), table_batch_sink(out), checkpoint, trigger=NOW))

    topic.send((1, message()), (5, message()), (12, message()), (19, message()))
    run()
    # Latest time 19: the window [0, 10) ends at 10 > 19 - 10.
    assert windows(spark, out) == []
    topic.send((31, message()))
    run()
    assert windows(spark, out) == [(0, 2), (10, 2)]
    # 2 and 13 belong to closed windows, 25 to one still open.
    topic.send((2, message()), (13, message()), (25, message()), (55, message()))
    run()
    assert windows(spark, out) == [(0, 2), (10, 2), (20, 1), (30, 1)]
    run()
    assert windows(spark, out) == [(0, 2), (10, 2), (20, 1), (30, 1)]


def test_window_values_and_cleaning(spark, topic, out, checkpoint):
    topic.send(
        (1, message(power=1.0, irradiation=0.5)),
        (2, message(power=3.0, irradiation=1.5)),
        (3, message(power=-3.0)),
        (4, message(irradiation=None)),
        (5, message(DATE_TIME="01-01-2024 00:00")),
        (6, "garbage"),
        (60, message()),
    )
    run_available(
        jobs.window_job(
            topic.records(), table_batch_sink(out), checkpoint, count_name="CLEAN_RECORDS", trigger=NOW
        )
    )
    schema = window_stats(sample(spark), count_name="CLEAN_RECORDS").schema
    row = read_batches(spark, out, schema).first().asDict()
    row.pop(BATCH_ID)
    assert row == {
        "WINDOW_START": T0,
        "WINDOW_END": T0 + timedelta(seconds=10),
        "CLEAN_RECORDS": 2,
        "AVG_POWER": 2.0,
        "MAX_POWER": 3.0,
        "MIN_POWER": 1.0,
        "AVG_IRRADIATION": 1.0,
    }


def test_running_totals_keep_a_history_of_snapshots(spark, topic, out, checkpoint):
    for powers in ([1.0, 2.0], [6.0], [-1.0]):
        topic.send(*[(i, message(power=p)) for i, p in enumerate(powers)])
        run_available(jobs.totals_job(topic.records(), table_batch_sink(out), checkpoint, trigger=NOW))
    snapshots = read_batches(spark, out, running_totals(sample(spark)).schema).orderBy(BATCH_ID)
    got = [(r["TOTAL_RECORDS"], r["AVG_POWER"], r["MAX_POWER"]) for r in snapshots.collect()]
    assert got == [(2, 1.5, 2.0), (3, 3.0, 6.0), (3, 3.0, 6.0)]


def test_archive_restarts_without_loss_or_duplicates(spark, topic, out, checkpoint):
    def run():
        run_available(jobs.archive_job(topic.records(), out, checkpoint, NOW))

    topic.send((0, message(power=1.0)), (1, "garbage"))
    run()
    run()
    topic.send((2, message(power=2.0, MONTH=2)))
    run()
    archive = read_archive(spark, out)
    assert archive.count() == 3
    assert archive.where("POWER_GENERATED IS NULL AND YEAR IS NULL").count() == 1
    assert archive.where("MONTH = 2").first()["POWER_GENERATED"] == 2.0


def test_flat_archive(spark, topic, out, checkpoint):
    topic.send((0, message()))
    decoded = decode_messages(topic.records(), arrival=None)
    run_available(archive_stream(decoded, out, checkpoint, NOW, partition_by=()))
    assert spark.read.parquet(out).columns == decoded.columns


def test_failed_batch_is_raised_and_repeated_without_duplicates(spark, topic, out, checkpoint):
    keep = table_batch_sink(out)

    def fail_after_writing(batch, batch_id):
        keep(batch, batch_id)
        raise OSError("sink is down")

    topic.send((0, message()), (1, message()))
    decoded = decode_messages(topic.records())
    with pytest.raises(Exception, match="sink is down"):
        run_available(start_batches(decoded, fail_after_writing, checkpoint, trigger=NOW))
    assert read_batches(spark, out, decoded.schema).count() == 2
    run_available(start_batches(decoded, keep, checkpoint, trigger=NOW))
    assert read_batches(spark, out, decoded.schema).count() == 2


def test_small_batches_give_the_same_windows_as_a_table(spark, sf_dir, topic, out, checkpoint):
    view = telemetry_view(table(spark, sf_dir, "events"))
    ordered = view.select(
        F.to_json(F.struct(*readings(view).columns)).alias("value"), F.col("ts").alias("timestamp")
    ).cache()
    bounds = ordered.selectExpr("percentile(cast(timestamp as double), array(0.25, 0.5, 0.75)) p")
    cuts = [0.0, *bounds.first()["p"], 1e12]
    for low, high in zip(cuts, cuts[1:]):
        seconds = F.col("timestamp").cast("double")
        part = ordered.where((seconds >= low) & (seconds < high))
        part.coalesce(1).write.mode("append").parquet(topic.path)
    run_available(
        jobs.window_job(
            topic.records(maxFilesPerTrigger=1),
            table_batch_sink(out),
            checkpoint,
            size="1 hour",
            trigger=NOW,
        )
    )
    whole = window_stats(decode_messages(ordered), size="1 hour")
    last = ordered.agg(F.max("timestamp")).first()[0] - timedelta(seconds=10)
    closed = whole.where(F.col("WINDOW_END") <= F.lit(last))
    names = ["WINDOW_START", "TOTAL_RECORDS", "MAX_POWER", "MIN_POWER"]
    stored = read_batches(spark, out, whole.schema)
    assert stored.select(BATCH_ID).distinct().count() >= 4
    assert sorted(map(tuple, stored.select(names).collect())) == sorted(
        map(tuple, closed.select(names).collect())
    )


def test_scoring_job(spark, topic, out, checkpoint):
    train = decode_messages(
        spark.createDataFrame(
            [(message(power=float(i), DC_POWER=float(i)), T0) for i in range(20)], RECORDS
        ),
        arrival=None,
    )
    model = train_power_model(train, num_trees=2, max_depth=2)
    topic.send((0, message()), (1, message(DC_POWER="x")), (2, message(DATE_TIME="?")), (3, "no"))
    run_available(jobs.scoring_job(topic.records(), model, table_batch_sink(out), checkpoint, NOW))
    scored = spark.read.parquet(out)
    assert scored.count() == 2
    assert scored.where("PREDICTED_POWER IS NULL").count() == 0
    assert scored.where("EVENT_TIME IS NULL").count() == 1
    assert scored.select("PREDICTION_TIME").distinct().count() == 1
