"""The archive: skewed dates, repeated batches, other writers, missing dates."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattloom.plans import jobs
from wattloom.sinks import archive
from wattloom.sinks.archive import Share, manifest, share_tasks, write_archive_batch
from wattloom.sources.files import read_archive, stream_files
from wattloom.sources.messages import encode_messages
from wattloom.streaming.sinks import run_available

NOW = {"availableNow": True}


def dated(spark, n, parts=5):
    """A third of the rows on one date, a tenth without one, the others on 40 dates; all notes equal."""
    at = F.col("id")
    day = F.when(at % 3 == 0, 1).when(at % 10 == 1, F.lit(None)).otherwise(at % 40 % 28 + 1)
    month = F.when(at % 3 == 0, 1).when(at % 10 == 1, F.lit(None)).otherwise(at % 40 % 12 + 1)
    return spark.range(0, n, 1, parts).select(
        "id", F.lit(2024).alias("YEAR"), month.cast("int").alias("MONTH"), day.cast("int").alias("DAY"),
        F.lit("x").alias("note"),
    )


def rows(df):
    return sorted(map(str, df.collect()))


def test_tasks_for_dates():
    assert share_tasks([], 10) == ([], 0)
    assert share_tasks([10, 25, 3, 4, 4, 10, 1], 10) == (
        [Share(0, 1), Share(1, 3), Share(4, 1), Share(4, 1), Share(5, 1), Share(6, 1), Share(7, 1)],
        8,
    )
    shares, tasks = share_tasks([0, 5, 5, 5], 10)
    assert tasks == 2 and shares[1] == shares[2] != shares[3]


def test_no_task_holds_a_hot_date(spark, tmp_path):
    path, n = str(tmp_path / "archive"), 20_000
    batch = dated(spark, n)
    write_archive_batch(batch, path, "w", 0, rows_per_file=n // 40)
    stored = spark.read.parquet(path)
    # A task writes one file for each of its dates, named by its number.
    task = F.regexp_extract(F.input_file_name(), r"part-(\d+)-", 1)
    sizes = [r["count"] for r in stored.groupBy(task.alias("t")).count().collect()]
    assert sum(sizes) == n and max(sizes) <= 0.05 * n
    assert rows(read_archive(spark, path, batch.schema)) == rows(batch)
    listed = {r["PART"]: (r["ROWS"], r["FILES"]) for r in manifest(spark, path).collect()}
    assert listed["YEAR=2024/MONTH=1/DAY=1"][1] >= 13 and sum(r for r, _ in listed.values()) == n
    hot = stored.where("MONTH = 1 AND DAY = 1").select(F.input_file_name()).distinct().count()
    assert hot == listed["YEAR=2024/MONTH=1/DAY=1"][1]


def test_equal_rows_part_too(spark, tmp_path):
    path = str(tmp_path / "archive")
    batch = spark.range(0, 4000, 1, 40).select(
        *[F.lit(1).alias(c) for c in ("YEAR", "MONTH", "DAY")], F.lit("same").alias("note")
    )
    write_archive_batch(batch, path, "w", 0, rows_per_file=250)
    files = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert len(files) == 16 and max(r["count"] for r in files) < 400


def test_repeated_batches(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "archive")
    batch = dated(spark, 300)

    with monkeypatch.context() as m:
        m.setattr(archive, "MANIFEST_SCHEMA", "broken")
        with pytest.raises(Exception):
            write_archive_batch(batch, path, "w", 0)
    # The rows are there, the entry is not.
    write_archive_batch(batch.where("id < 100"), path, "w", 1)
    assert read_archive(spark, path, batch.schema).count() == 100
    write_archive_batch(batch, path, "w", 0)
    assert rows(read_archive(spark, path, batch.schema)) == rows(batch.unionAll(batch.where("id < 100")))
    # A complete batch is not written again.
    write_archive_batch(batch.limit(0), path, "w", 0)
    assert read_archive(spark, path, batch.schema).count() == 400
    # The same number from another stream is another batch.
    write_archive_batch(batch.where("id < 7"), path, "other", 0)
    assert read_archive(spark, path, batch.schema).count() == 407
    assert read_archive(spark, path, None).count() == 407


def test_empty_batches(spark, tmp_path):
    path = str(tmp_path / "archive")
    none = dated(spark, 0)
    write_archive_batch(none, path, "w", 0)
    assert read_archive(spark, path, none.schema).collect() == []
    write_archive_batch(dated(spark, 5), path, "w", 1)
    assert read_archive(spark, path, none.schema).count() == 5
    assert [r["ROWS"] for r in manifest(spark, path).where("BATCH_ID = 0").collect()] == [0]


def test_a_stream_that_starts_over_is_another_writer(spark, tmp_path):
    inbox, path = str(tmp_path / "inbox"), str(tmp_path / "archive")
    rows_in = [(datetime(2024, 1, 1) + timedelta(days=i % 2), i) for i in range(6)]
    records = encode_messages(
        spark.createDataFrame(rows_in, "t timestamp, PLANT_ID int").select(
            "PLANT_ID", F.year("t").alias("YEAR"), F.month("t").alias("MONTH"), F.dayofmonth("t").alias("DAY")
        )
    ).withColumn("timestamp", F.lit(datetime(2024, 1, 1)))
    records.write.parquet(inbox)
    for checkpoint in ("one", "one", "two"):
        stream = stream_files(spark, inbox, records.schema)
        run_available(jobs.archive_job(stream, path, str(tmp_path / checkpoint), NOW))
    assert read_archive(spark, path).count() == 12
    assert manifest(spark, path).select("WRITER").distinct().count() == 2
