import json
import math
from datetime import datetime

from pyspark.sql import functions as F

from tests.test_clean import NAN, reading, table
from wattloom.schema import READING_SCHEMA
from wattloom.sources.messages import decode_messages, encode_messages

ARRIVED = datetime(2024, 1, 1, 10, 0, 3)


def records(spark, *texts):
    df = spark.createDataFrame([(t, ARRIVED) for t in texts], "value string, timestamp timestamp")
    return df.withColumn("value", F.col("value").cast("binary"))


def test_roundtrip_keeps_values_and_missing_ones(spark):
    df = table(spark, reading(), reading(PLANT_ID=None, SOURCE_KEY="ü \"q\""))
    back = decode_messages(encode_messages(df), arrival=None)
    assert back.schema == READING_SCHEMA
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_every_message_has_every_field(spark):
    text = encode_messages(table(spark, reading(PLANT_ID=None))).first()["value"]
    message = json.loads(text)
    assert list(message) == READING_SCHEMA.fieldNames()
    assert message["PLANT_ID"] is None


def test_arrival_time_is_carried(spark):
    row = decode_messages(records(spark, '{"PLANT_ID": 3}')).first()
    assert row["STREAM_TIMESTAMP"] == ARRIVED and row["PLANT_ID"] == 3
    renamed = decode_messages(records(spark, "{}"), arrival="KAFKA_TIMESTAMP")
    assert renamed.columns[0] == "KAFKA_TIMESTAMP"


def test_text_that_is_not_json_gives_nulls(spark):
    out = decode_messages(records(spark, "garbage", '{"PLANT_ID": 1', "", None), arrival=None)
    rows = out.collect()
    assert len(rows) == 4
    assert all(r["DATE_TIME"] is None for r in rows)


def test_one_bad_field_spoils_only_itself(spark):
    row = decode_messages(records(spark, '{"PLANT_ID": "x", "HOUR": 7, "DC_POWER": 2}')).first()
    assert (row["PLANT_ID"], row["HOUR"], row["DC_POWER"]) == (None, 7, 2.0)


def test_nan_token(spark):
    text = '{"PLANT_ID": 1, "DC_POWER": NaN}'
    assert math.isnan(decode_messages(records(spark, text)).first()["DC_POWER"])
    assert decode_messages(records(spark, text), nan_as_null=True).first()["DC_POWER"] is None
    encoded = encode_messages(table(spark, reading(DC_POWER=NAN)))
    assert math.isnan(decode_messages(encoded, arrival=None).first()["DC_POWER"])


def test_filters_do_not_repeat_the_parser(spark):
    decoded = decode_messages(records(spark, "{}")).where("PLANT_ID > 0 AND HOUR > 1")
    plan = decoded._jdf.queryExecution().executedPlan().toString()
    assert plan.lower().count("from_json") == 1
