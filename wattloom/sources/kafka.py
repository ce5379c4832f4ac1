"""Message topics.  Needs the Spark Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str, topic: str, starting: str, fail_on_data_loss: bool | None = None, **extra: str
) -> dict[str, str]:
    """Connector options; ``fail_on_data_loss=None`` leaves the connector's default."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        **extra,
    }
    if fail_on_data_loss is not None:
        options["failOnDataLoss"] = str(fail_on_data_loss).lower()
    return options


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    fail_on_data_loss: bool | None = False,
    **extra: str,
) -> DataFrame:
    """Unbounded stream of records (``value`` bytes, arrival ``timestamp``, …)."""
    options = kafka_options(servers, topic, starting, fail_on_data_loss, **extra)
    return spark.readStream.format("kafka").options(**options).load()


def read_kafka_batch(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    """The whole topic, from the earliest record to the current end, as a table."""
    options = kafka_options(servers, topic, "earliest", None, **extra)
    return spark.read.format("kafka").options(**options).load()
