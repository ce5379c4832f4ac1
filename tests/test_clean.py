import json
import subprocess
import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wattloom.functions.missing import complete_rows, nan_to_null
from wattloom.operators import clean
from wattloom.operators.clean import (
    clean_readings,
    dedupe,
    enforce_types,
    export_columns,
    validate_for_scoring,
)
from wattloom.operators.profile import duplicate_count
from wattloom.schema import READING_SCHEMA

NAN = float("nan")


def reading(**changes):
    row = {
        "DATE_TIME": "2024-01-01 10:00:00",
        "PLANT_ID": 1,
        "SOURCE_KEY": "a",
        "DC_POWER": 1.0,
        "AC_POWER": 1.0,
        "DAILY_YIELD": 1.0,
        "TOTAL_YIELD": 1.0,
        "AMBIENT_TEMPERATURE": 1.0,
        "MODULE_TEMPERATURE": 1.0,
        "IRRADIATION": 1.0,
        "YEAR": 2024,
        "MONTH": 1,
        "DAY": 1,
        "HOUR": 10,
        "DAY_OF_WEEK": 0,
        "POWER_GENERATED": 1.0,
    }
    row.update(changes)
    return tuple(row[f] for f in READING_SCHEMA.fieldNames())


def table(spark, *rows):
    return spark.createDataFrame(list(rows), READING_SCHEMA)


CASES = [
    # change, kept by clean, kept with nan_as_null, kept by validate
    ({}, True, True, True),
    ({"DATE_TIME": None}, False, False, False),
    ({"DATE_TIME": "01-01-2024 10:00"}, False, False, True),
    ({"PLANT_ID": None}, False, False, False),
    ({"POWER_GENERATED": None}, False, False, False),
    ({"POWER_GENERATED": NAN}, False, False, True),
    ({"POWER_GENERATED": -0.1}, False, False, False),
    ({"POWER_GENERATED": 0.0}, True, True, True),
    ({"IRRADIATION": None}, False, False, False),
    ({"IRRADIATION": NAN}, True, False, True),
    ({"IRRADIATION": -1.0}, False, False, False),
    ({"AC_POWER": None}, True, True, False),
    ({"DC_POWER": None}, True, True, False),
    ({"DC_POWER": NAN}, True, True, True),
    ({"SOURCE_KEY": None}, True, True, True),
]


@pytest.mark.parametrize("change, clean, strict, valid", CASES)
def test_which_rows_stay(spark, change, clean, strict, valid):
    df = table(spark, reading(**change))
    assert clean_readings(df).count() == int(clean)
    assert clean_readings(df, nan_as_null=True).count() == int(strict)
    assert validate_for_scoring(df).count() == int(valid)


def test_clean_parses_the_time_and_validate_does_not(spark):
    df = table(spark, reading())
    assert clean_readings(df).first()["DATE_TIME"] == datetime(2024, 1, 1, 10)
    assert validate_for_scoring(df).first()["DATE_TIME"] == "2024-01-01 10:00:00"


def test_clean_accepts_a_parsed_time(spark):
    df = table(spark, reading()).withColumn("DATE_TIME", F.to_timestamp("DATE_TIME"))
    assert clean_readings(df).count() == 1


def test_complete_rows_equals_dropna(spark):
    df = table(spark, reading(), reading(DC_POWER=NAN), reading(HOUR=None), reading(AC_POWER=None))
    columns = ["DC_POWER", "HOUR", "AC_POWER"]
    assert complete_rows(df, columns).count() == df.dropna(subset=columns).count() == 1


def test_clean_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "archive")
    table(spark, reading()).write.parquet(path)
    plan = clean_readings(spark.read.parquet(path))._jdf.queryExecution().toString()
    pushed = plan[plan.rindex("PushedFilters") :]
    assert "IsNotNull(POWER_GENERATED), GreaterThanOrEqual(POWE" in pushed
    assert "IsNotNull(PLANT_ID)" in pushed


def test_enforce_types(spark):
    text = spark.createDataFrame(
        [("7", "1.5", "x", "k"), ("seven", "", None, None)],
        "PLANT_ID string, DC_POWER string, SOURCE_KEY string, EXTRA string",
    )
    out = enforce_types(text)
    assert dict(out.dtypes) == {
        "PLANT_ID": "int",
        "DC_POWER": "double",
        "SOURCE_KEY": "string",
        "EXTRA": "string",
    }
    assert [tuple(r) for r in out.collect()] == [(7, 1.5, "x", "k"), (None, None, None, None)]


def test_enforce_types_is_free_on_typed_rows(spark):
    df = table(spark, reading())
    plan = enforce_types(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "cast" not in plan.lower()


def test_dedupe_takes_null_and_nan_as_equal(spark):
    rows = [reading(), reading(), reading(DC_POWER=NAN), reading(DC_POWER=NAN)]
    rows += [reading(PLANT_ID=None), reading(PLANT_ID=None), reading(PLANT_ID=2)]
    once = dedupe(table(spark, *rows))
    assert once.count() == 4
    assert dedupe(once).count() == 4


def test_export_and_nan_to_null(spark):
    df = table(spark, reading(DC_POWER=NAN))
    assert export_columns(df, ["PLANT_ID", "HOUR"]).columns == ["PLANT_ID", "HOUR"]
    assert nan_to_null(df).first()["DC_POWER"] is None


def wide(spark, n):
    """Random rows of 12 columns; ``n`` of them."""
    values = [F.rand(i).alias(f"v{i}") for i in range(10)]
    return spark.range(n).select("id", *values, F.sha2(F.col("id").cast("string"), 256).alias("text"))


@pytest.mark.parametrize("digest_first", [True, False, None])
def test_dedupe_of_wide_rows(spark, digest_first):
    rows = wide(spark, 300)
    again = rows.where("id % 7 = 0")
    odd = [reading(DC_POWER=NAN), reading(DC_POWER=None), reading(DC_POWER=0.0), reading(DC_POWER=-0.0)]
    many = rows.unionAll(again).unionAll(again.where("id % 3 = 0"))
    once = dedupe(many, digest_first)
    assert once.columns == rows.columns
    assert once.exceptAll(rows).count() == rows.exceptAll(once).count() == 0
    assert duplicate_count(many, digest_first).first()[0] == many.count() - 300
    assert dedupe(table(spark, *odd, *odd), digest_first).count() == 3
    assert duplicate_count(table(spark, *odd, *odd), digest_first).first()[0] == 5
    assert dedupe(rows.limit(0), digest_first).count() == 0


def test_rows_of_one_digest_are_compared_in_full(spark, monkeypatch):
    monkeypatch.setattr(clean, "_digest_columns", lambda df: {c: F.lit(1).cast("long") for c in clean._DIGESTS})
    rows = wide(spark, 20)
    assert dedupe(rows.unionAll(rows), True).count() == 20
    assert duplicate_count(rows.unionAll(rows), True).first()[0] == 20


def test_many_repeated_digests_are_merged_as_usual(spark, monkeypatch):
    monkeypatch.setattr(clean, "BROADCAST_BYTES", 0)
    rows = wide(spark, 50)
    assert dedupe(rows.unionAll(rows), True).count() == 50


def shuffled_bytes(folder):
    """Shuffle bytes of all tasks in the event logs of a folder."""
    written = 0
    for log in Path(folder).rglob("*"):
        if log.is_file() and not log.name.endswith(".crc"):
            for line in log.read_text().splitlines():
                event = json.loads(line)
                metrics = event.get("Task Metrics") or {}
                written += metrics.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
    return written


def test_unique_wide_rows_hardly_move(tmp_path):
    """In a session of its own, whose event log has the bytes."""
    sizes = {}
    for way in ("True", "False"):
        logs = tmp_path / way
        logs.mkdir()
        script = f"""
from pyspark.sql import SparkSession
from tests.test_clean import wide
from wattloom.operators.clean import dedupe
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://{logs}")
    .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false")
    .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", "{tmp_path}/shared").getOrCreate())
wide(spark, 20000).write.mode("overwrite").parquet("{tmp_path}/wide")
assert dedupe(spark.read.parquet("{tmp_path}/wide"), {way}).count() == 20000
spark.stop()
"""
        root = str(Path(__file__).resolve().parents[1])
        subprocess.run([sys.executable, "-c", script], check=True, cwd=root, timeout=300, capture_output=True)
        sizes[way] = shuffled_bytes(logs)
    assert 0 < 4 * sizes["True"] < sizes["False"]
