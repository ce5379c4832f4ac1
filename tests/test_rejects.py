"""Counts of dropped rows by micro-batch, next to the statistics that drop them."""

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import NOW, RECORDS, T0, Topic, message
from wattloom.plans import jobs
from wattloom.sources.messages import decode_messages
from wattloom.streaming.rejects import (
    LATEST,
    count_window_rejects,
    counted_sink,
    read_counts,
    reject_measures,
    reject_reason,
)
from wattloom.streaming.sinks import BATCH_ID, read_batches, run_available, start_batches, table_batch_sink
from wattloom.streaming.windows import window_stats


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


def counts(spark, path):
    rows = read_counts(spark, path).orderBy(BATCH_ID).collect()
    return [tuple(r[c] for c in ("TOTAL", "KEPT", "UNDECODABLE", "INCOMPLETE", "NEGATIVE", "LATE")) for r in rows]


def test_reasons(spark):
    messages = [
        message(),
        "garbage",
        "{}",
        message(power=None),
        message(DATE_TIME="01/02/2024"),
        message(power=float("nan")),
        message(power=-1.0),
        message(irradiation=None),
        message(irradiation=float("nan")),
        message(power=-1.0, PLANT_ID=None),
    ]
    decoded = decode_messages(spark.createDataFrame([(m, T0) for m in messages], RECORDS))
    got = [r[0] for r in decoded.select(reject_reason(decoded)).collect()]
    assert got == [
        None, "UNDECODABLE", "UNDECODABLE", "INCOMPLETE", "INCOMPLETE", "INCOMPLETE", "NEGATIVE", "NEGATIVE",
        None, "INCOMPLETE",
    ]
    assert decoded.select(reject_reason(decoded, nan_as_null=True)).collect()[8][0] == "NEGATIVE"


def test_late_rows_are_those_the_windows_drop(spark, topic, tmp_path):
    out, seen = str(tmp_path / "out"), str(tmp_path / "seen")
    batches = [
        [(1, message()), (5, message()), (12, message()), (19, message()), (2, "garbage"), (400, "garbage")],
        [(31, message()), (500, message(power=-1.0))],
        # The watermark is 21: windows that end at 10 and 20 are closed, 21 lies in an open one.
        [(2, message()), (13, message()), (19, message(irradiation=None)), (21, message()), (55, message())],
    ]
    for batch in batches:
        topic.send(*batch)
        run_available(
            jobs.window_job(topic.records(), table_batch_sink(out), str(tmp_path / "c1"), trigger=NOW)
        )
        run_available(
            count_window_rejects(decode_messages(topic.records()), seen, str(tmp_path / "c2"), trigger=NOW)
        )
    assert counts(spark, seen) == [(6, 4, 2, 0, 0, 0), (2, 1, 0, 0, 1, 0), (5, 2, 0, 0, 1, 2)]
    layout = window_stats(decode_messages(spark.createDataFrame([(message(), T0)], RECORDS))).schema
    stored = read_batches(spark, out, layout).agg(F.sum("TOTAL_RECORDS")).first()[0]
    # All kept rows but the latest one, whose window is still open.
    assert stored == 4 + 1 + 2 - 1


def test_a_repeated_batch_counts_the_same(spark, topic, tmp_path):
    seen = str(tmp_path / "seen")
    topic.send((100, message()), (200, message()))
    decoded = decode_messages(topic.records())
    run_available(count_window_rejects(decoded, seen, str(tmp_path / "one"), trigger=NOW))
    # A lost checkpoint: the same batch comes again under the same number.
    run_available(count_window_rejects(decoded, seen, str(tmp_path / "two"), trigger=NOW))
    assert counts(spark, seen) == [(2, 2, 0, 0, 0, 0)]
    assert read_counts(spark, str(tmp_path / "none")).count() == 0
    assert read_counts(spark, seen).first()[LATEST] is not None


def test_counts_come_with_the_rows_that_a_sink_writes(spark, topic, tmp_path):
    out, seen = str(tmp_path / "out"), str(tmp_path / "seen")

    def kept(batch, batch_id):
        table_batch_sink(out)(batch.where(reject_reason(batch).isNull()), batch_id)

    sink = counted_sink(kept, lambda df: reject_measures(reject_reason(df)), seen)
    for batch in ([(0, message()), (1, "x")], [(2, message(power=None)), (3, message()), (4, message())]):
        topic.send(*batch)
        run_available(start_batches(decode_messages(topic.records()), sink, str(tmp_path / "c"), trigger=NOW))
    assert counts(spark, seen) == [(2, 1, 1, 0, 0, 0), (3, 2, 0, 1, 0, 0)]
    assert spark.read.parquet(out).count() == 3
