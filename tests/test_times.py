from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wattloom.functions.times import (
    MIXED_FORMATS_DAY_FIRST,
    day_name,
    floor_hour,
    parse_event_time,
    parse_mixed_timestamp,
    weekend_flag,
)


def one(spark, value, expression):
    df = spark.createDataFrame([(value,)], "c string")
    return df.select(expression.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, month_first, day_first",
    [
        ("2020-05-15 13:45:10", datetime(2020, 5, 15, 13, 45, 10), None),
        ("2020-05-15 13:45", datetime(2020, 5, 15, 13, 45), None),
        ("2020-05-15T13:45:10", datetime(2020, 5, 15, 13, 45, 10), None),
        ("2020-05-15", datetime(2020, 5, 15), None),
        ("2020-5-1 7:05", datetime(2020, 5, 1, 7, 5), None),
        ("2020-05-15 13:45:10.25", datetime(2020, 5, 15, 13, 45, 10, 250000), None),
        ("15-05-2020 00:15", datetime(2020, 5, 15, 0, 15), None),
        ("05-15-2020 00:15", datetime(2020, 5, 15, 0, 15), None),
        ("01-06-2020 10:00", datetime(2020, 1, 6, 10), datetime(2020, 6, 1, 10)),
        ("1/6/2020 7:05", datetime(2020, 1, 6, 7, 5), datetime(2020, 6, 1, 7, 5)),
        (" 31/12/2020 ", datetime(2020, 12, 31), None),
        ("2020/05/15 00:15", datetime(2020, 5, 15, 0, 15), None),
        ("20200515", datetime(2020, 5, 15), None),
        ("20200515 13:45:10", datetime(2020, 5, 15, 13, 45, 10), None),
        ("15-May-2020 00:00", datetime(2020, 5, 15), None),
        ("3 aug 2020", datetime(2020, 8, 3), None),
        ("Aug 3, 2020 1:05 pm", datetime(2020, 8, 3, 13, 5), None),
        ("05/15/2020 1:30 PM", datetime(2020, 5, 15, 13, 30), None),
        ("12/31/2020 12:00:07 AM", datetime(2020, 12, 31, 0, 0, 7), None),
        ("15.05.2020 00:15", datetime(2020, 5, 15, 0, 15), None),
        ("05.06.2020 07:15", datetime(2020, 5, 6, 7, 15), datetime(2020, 6, 5, 7, 15)),
    ],
)
def test_mixed_formats(spark, text, month_first, day_first):
    assert one(spark, text, parse_mixed_timestamp("c")) == month_first
    other = one(spark, text, parse_mixed_timestamp("c", MIXED_FORMATS_DAY_FIRST))
    assert other == (day_first or month_first)


@pytest.mark.parametrize("text", ["", "n/a", "2020-13-45", "99-99-2020 10:00", "30-02-2020 10:00", "10:00", None])
def test_unreadable_text_is_null(spark, text):
    assert one(spark, text, parse_mixed_timestamp("c")) is None


def test_unreadable_text_can_raise(spark):
    assert one(spark, None, parse_mixed_timestamp("c", errors="raise")) is None
    with pytest.raises(Exception, match="unreadable timestamp: n/a"):
        one(spark, "n/a", parse_mixed_timestamp("c", errors="raise"))
    with pytest.raises(ValueError):
        parse_mixed_timestamp("c", errors="ignore")


def test_format_with_unknown_letters_still_parses(spark):
    parsed = parse_mixed_timestamp("c", ["d MMM yyyy HH:mm"])
    assert one(spark, "3 Feb 2021 04:05", parsed) == datetime(2021, 2, 3, 4, 5)


def test_format_with_optional_part_still_parses(spark):
    parsed = parse_mixed_timestamp("c", ["dd.MM.yyyy[ HH:mm]"])
    assert one(spark, "03.02.2021", parsed) == datetime(2021, 2, 3)
    assert one(spark, "03.02.2021 04:05", parsed) == datetime(2021, 2, 3, 4, 5)


def test_event_time_takes_one_format(spark):
    assert one(spark, "2024-01-31 23:59:59", parse_event_time("c")) == datetime(2024, 1, 31, 23, 59, 59)
    assert one(spark, "31-01-2024 23:59", parse_event_time("c")) is None
    assert one(spark, "2024-02-30 00:00:00", parse_event_time("c")) is None


def test_calendar_parts(spark):
    t = F.to_timestamp("c")
    assert one(spark, "2024-01-06 13:45:10", floor_hour(t)) == datetime(2024, 1, 6, 13)
    assert one(spark, "2024-01-06 13:45:10", day_name(t)) == "Saturday"
    assert one(spark, "2024-01-06 13:45:10", weekend_flag(t)) == 1
    assert one(spark, "2024-01-08 13:45:10", weekend_flag(t)) == 0
    assert one(spark, None, weekend_flag(t)) == 0
