import math

from pyspark.sql import functions as F

from tests.test_clean import NAN, reading, table
from wattloom.operators import reports


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_undecodable_rows_form_a_null_group_that_comes_first(spark):
    empty = tuple([None] * 16)
    df = table(spark, reading(HOUR=2), reading(HOUR=1, POWER_GENERATED=3.0), empty)
    assert rows(reports.total_records(df)) == [(3,)]
    assert rows(reports.hourly_power(df)) == [(None, None), (1, 3.0), (2, 1.0)]


def test_rounding_is_half_up_on_the_decimal_text(spark):
    df = table(spark, reading(POWER_GENERATED=2.675), reading(POWER_GENERATED=2.675))
    assert rows(reports.average_power(df)) == [(2.68,)]
    df = table(spark, reading(AMBIENT_TEMPERATURE=20.25), reading(AMBIENT_TEMPERATURE=20.34))
    assert rows(reports.power_by_temperature(df)) == [(20.3, 1.0)]


def test_bucket_columns(spark):
    df = table(spark, reading(IRRADIATION=0.123), reading(IRRADIATION=0.118, POWER_GENERATED=2.0))
    out = reports.power_by_irradiation(df)
    assert out.columns == ["IRRADIATION", "AVG_POWER"]
    assert rows(out) == [(0.12, 1.5)]


def test_group_order(spark):
    df = table(
        spark,
        reading(YEAR=2024, MONTH=2),
        reading(YEAR=2023, MONTH=12),
        reading(YEAR=2024, MONTH=1, DAY=9),
        reading(YEAR=2024, MONTH=1, DAY=2),
    )
    assert [r[:2] for r in rows(reports.monthly_power(df))] == [(2023, 12), (2024, 1), (2024, 2)]
    assert [r[2] for r in rows(reports.daily_power(df))] == [1, 2, 9, 1]


def test_top_readings_put_missing_last_and_break_ties(spark):
    df = table(
        spark,
        reading(POWER_GENERATED=None),
        reading(POWER_GENERATED=5.0, PLANT_ID=2),
        reading(POWER_GENERATED=5.0, PLANT_ID=1),
        reading(POWER_GENERATED=9.0),
    )
    top = rows(reports.top_readings(df, n=3))
    assert [(r[1], r[2]) for r in top] == [(1, 9.0), (1, 5.0), (2, 5.0)]
    plan = reports.top_readings(df)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_extremes(spark):
    df = table(spark, reading(POWER_GENERATED=1.5), reading(POWER_GENERATED=-2.0), reading(POWER_GENERATED=None))
    assert rows(reports.max_power(df)) == [(1.5,)]
    assert rows(reports.min_power(df)) == [(-2.0,)]
    poisoned = df.unionByName(table(spark, reading(POWER_GENERATED=NAN)))
    assert math.isnan(reports.max_power(poisoned).first()[0])
    assert reports.max_power(df.where(F.lit(False))).first()[0] is None


def test_all_reports(spark):
    df = table(spark, reading())
    found = reports.all_reports(df)
    assert len(found) == 12
    assert all(frame.count() == 1 for frame in found.values())
