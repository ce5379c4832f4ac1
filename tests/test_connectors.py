"""Connectors whose other side is not available here: only the calls are checked."""

from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql.streaming import DataStreamReader

from tests.test_clean import reading, table
from wattloom.sinks.jdbc import jdbc_batch_sink, write_jdbc
from wattloom.sinks.kafka import write_kafka
from wattloom.sources.kafka import kafka_options, read_kafka, read_kafka_batch
from wattloom.workspace import materialize, new_path, scratch, workspace_root

PROPERTIES = {"user": "u", "driver": "d"}


@pytest.fixture
def jdbc_calls(monkeypatch):
    calls = []

    def jdbc(writer, url, table, properties):
        calls.append((url, table, properties, writer._df))

    def mode(writer, value):
        calls.append(value)
        return writer

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    monkeypatch.setattr(DataFrameWriter, "mode", mode)
    return calls


def test_write_jdbc_overwrites_by_default(spark, jdbc_calls):
    df = table(spark, reading())
    write_jdbc(df, "jdbc:x", "t", PROPERTIES)
    assert jdbc_calls[0] == "overwrite"
    assert jdbc_calls[1] == ("jdbc:x", "t", PROPERTIES, df)


def test_batch_sink_removes_an_earlier_attempt_then_appends(spark, jdbc_calls):
    removed = []
    sink = jdbc_batch_sink("jdbc:x", "t", PROPERTIES, delete_batch=removed.append)
    sink(table(spark, reading()), 7)
    assert removed == [7]
    assert jdbc_calls[0] == "append"
    frame = jdbc_calls[1][3]
    assert frame.columns[-1] == "BATCH_ID" and frame.first()["BATCH_ID"] == 7


def test_batch_sink_can_leave_the_columns_alone(spark, jdbc_calls):
    df = table(spark, reading())
    jdbc_batch_sink("jdbc:x", "t", PROPERTIES, batch_column=None, at_least_once=True)(df, 0)
    assert jdbc_calls[1][3] is df


def test_batch_sink_raises(spark, monkeypatch):
    def jdbc(*_, **__):
        raise OSError("no database")

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    with pytest.raises(OSError, match="no database"):
        jdbc_batch_sink("jdbc:x", "t", PROPERTIES, at_least_once=True)(table(spark, reading()), 0)


def test_batch_sink_asks_how_to_treat_repeated_batches():
    with pytest.raises(ValueError, match="delete_batch"):
        jdbc_batch_sink("jdbc:x", "t", PROPERTIES)


def test_kafka_options():
    assert kafka_options("h:1", "t", "latest", False, maxOffsetsPerTrigger="5") == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "5",
        "failOnDataLoss": "false",
    }
    assert "failOnDataLoss" not in kafka_options("h:1", "t", "earliest")


def test_kafka_stream_reader_call(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(DataStreamReader, "load", lambda reader: seen.setdefault("loaded", True))
    read_kafka(spark, "h:1", "t")
    assert seen["loaded"]


@pytest.mark.parametrize(
    "call",
    [
        lambda spark: read_kafka_batch(spark, "h:1", "t"),
        lambda spark: write_kafka(table(spark, reading()), "h:1", "t"),
    ],
)
def test_kafka_needs_its_connector(spark, call):
    with pytest.raises(Exception, match="kafka"):
        call(spark)


def test_workspace_is_the_configured_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert workspace_root(spark) == root
    assert new_path(spark, "x").startswith(f"{root}/x-")
    assert new_path(spark, "x") != new_path(spark, "x")


class _Session:
    """Stands in for a session without a shared folder."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": master})


def test_workspace_without_configuration():
    assert "wattloom-" in workspace_root(_Session("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace_root(_Session("yarn"))


def test_scratch_removes_what_was_stored_inside(spark):
    root = Path(workspace_root(spark))
    kept = materialize(spark.range(3), "kept")
    before = {p.name for p in root.iterdir()}
    with scratch(spark):
        with scratch(spark):
            assert materialize(spark.range(5), "inner").count() == 5
        outer = materialize(spark.range(7), "outer")
        assert outer.count() == 7 and {p.name for p in root.iterdir()} > before
    assert {p.name for p in root.iterdir()} == before and kept.count() == 3
