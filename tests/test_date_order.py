import pytest
from datetime import datetime

from pyspark.sql import functions as F

from wattloom.operators import lookup_join
from wattloom.operators.date_order import (
    ambiguous_dates,
    date_order_evidence,
    order_kind,
    parse_by_evidence,
)

ROWS = [
    ("us", "01/31/2024 10:00"),
    ("us", "02/03/2024 10:00"),
    ("eu", "31.01.2024"),
    ("eu", "02.03.2024"),
    ("eu", "2024-05-06"),
    ("mix", "31-01-2024"),
    ("mix", "01-31-2024"),
    ("mix", "02-03-2024"),
    ("unsure", "02/03/2024"),
    ("unsure", "04/04/2024"),
    ("unsure", None),
    (None, "13/02/2024"),
    (None, "03/02/2024"),
    ("empty", None),
]


@pytest.fixture
def dates(spark):
    return spark.createDataFrame([(s, t, i) for i, (s, t) in enumerate(ROWS)], "source string, t string, i int")


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("1/2/2024", "EITHER_ORDER"),
        ("2-2-2024 01:02", "SAME_IN_BOTH"),
        ("12.13.2024", "MONTH_FIRST_ONLY"),
        ("13.12.2024", "DAY_FIRST_ONLY"),
        ("13.13.2024", "NOT_YEAR_LAST"),
        ("32/1/2024", "NOT_YEAR_LAST"),
        ("0/1/2024", "NOT_YEAR_LAST"),
        ("1/2-2024", "NOT_YEAR_LAST"),
        ("1/2/20245", "NOT_YEAR_LAST"),
        ("2024-01-02", "NOT_YEAR_LAST"),
        ("", "NOT_YEAR_LAST"),
        (None, None),
    ],
)
def test_kinds(spark, text, kind):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(order_kind(F.col("t"))).first()[0] == kind


def test_evidence_by_source(dates):
    got = {r["source"]: tuple(r)[1:] for r in date_order_evidence(dates, "t", ["source"]).collect()}
    assert got == {
        "us": (1, 0, 1, 0, 0, "month first"),
        "eu": (0, 1, 1, 0, 1, "day first"),
        "mix": (1, 1, 1, 0, 0, "both"),
        "unsure": (0, 0, 1, 1, 0, "none"),
        None: (0, 1, 1, 0, 0, "day first"),
        "empty": (0, 0, 0, 0, 0, "none"),
    }


@pytest.mark.parametrize("limit", [64 * 1024 * 1024, 0])
def test_times_are_read_by_evidence(dates, monkeypatch, limit):
    monkeypatch.setattr(lookup_join.lookup_join, "__defaults__", tuple(
        limit if d == lookup_join.BROADCAST_BYTES else d for d in lookup_join.lookup_join.__defaults__
    ))
    got = {r["i"]: r["t"] for r in parse_by_evidence(dates, "t", ["source"]).collect()}
    assert len(got) == len(ROWS)
    assert got[1] == datetime(2024, 2, 3, 10) and got[3] == datetime(2024, 3, 2)
    assert got[4] == datetime(2024, 5, 6) and got[5] == got[6] == datetime(2024, 1, 31)
    assert got[7] == datetime(2024, 2, 3) and got[8] == datetime(2024, 2, 3)
    assert got[11] == datetime(2024, 2, 13) and got[12] == datetime(2024, 2, 3)
    assert got[10] is None and got[13] is None


def test_ambiguous_rows(dates):
    got = ambiguous_dates(dates, "t", ["source"])
    assert sorted((r["i"], r["DATE_ORDER"]) for r in got.collect()) == [(7, "both"), (8, "none")]
    assert got.columns == ["source", "t", "i", "DATE_ORDER"]
