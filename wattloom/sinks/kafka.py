"""Publish rows to a message topic.  Needs the Spark Kafka connector."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wattloom.sources.messages import encode_messages


def write_kafka(df: DataFrame, servers: str, topic: str, **extra: str) -> None:
    """Send each row as one JSON message, in parallel from the executors."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, **extra}
    encode_messages(df).write.format("kafka").options(**options).save()
