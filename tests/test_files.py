from datetime import datetime

import pytest
from pyspark.sql import types as T

from tests.test_clean import NAN, reading, table
from wattloom.plans.offline import master_table, rejected_times
from wattloom.schema import GENERATION_SCHEMA, MISSING_TOKENS, READING_SCHEMA, WEATHER_SCHEMA
from wattloom.sinks.files import write_csv
from wattloom.sources.files import csv_rejects, read_archive, read_csv, register_view

SCHEMA = T.StructType(
    [
        T.StructField("N", T.IntegerType()),
        T.StructField("X", T.DoubleType()),
        T.StructField("S", T.StringType()),
    ]
)


def write(path, text):
    path.write_text(text)
    return str(path)


def test_missing_tokens_and_bad_numbers_are_null(spark, tmp_path):
    lines = "\n".join(f"1,{t},{t}" for t in MISSING_TOKENS)
    path = write(tmp_path / "a.csv", f"N,X,S\n{lines}\nx,2.5,ok\n")
    rows = read_csv(spark, path, SCHEMA).collect()
    assert len(rows) == len(MISSING_TOKENS) + 1
    assert all(r["X"] is None and r["S"] is None for r in rows[:-1])
    assert tuple(rows[-1]) == (None, 2.5, "ok")


def test_header_must_match(spark, tmp_path):
    path = write(tmp_path / "b.csv", "N,S,X\n1,a,2.0\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path, SCHEMA).collect()


def test_many_files_are_one_table(spark, tmp_path):
    paths = [write(tmp_path / f"{i}.csv", f"N,X,S\n{i},1.0,a\n") for i in range(3)]
    assert sorted(r["N"] for r in read_csv(spark, paths, SCHEMA).collect()) == [0, 1, 2]


def test_csv_roundtrip_of_awkward_text(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [(1, 2.5, 'say "hi", ok'), (2, None, " padded "), (3, 1e300, "back\\slash")]
    write_csv(spark.createDataFrame(rows, SCHEMA), path)
    write_csv(spark.createDataFrame(rows, SCHEMA), path)
    assert sorted(tuple(r) for r in read_csv(spark, path, SCHEMA).collect()) == rows


def test_csv_text_of_times_and_missing_values(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [(datetime(2024, 1, 2, 3, 4, 5), NAN, None)]
    write_csv(spark.createDataFrame(rows, "t timestamp, x double, s string").coalesce(1), path)
    assert [r["value"] for r in spark.read.text(path).collect()] == [
        "t,x,s",
        "2024-01-02 03:04:05,,",
    ]


def test_archive_and_view(spark, tmp_path):
    path = str(tmp_path / "archive")
    df = table(spark, reading(), reading(YEAR=None), reading(MONTH=2))
    df.write.partitionBy("YEAR", "MONTH").parquet(path)
    archive = read_archive(spark, path)
    assert archive.columns == READING_SCHEMA.fieldNames()
    assert sorted(map(str, archive.collect())) == sorted(map(str, df.collect()))
    register_view(archive, "archived")
    assert spark.sql("SELECT count(*) AS n FROM archived WHERE MONTH = 2").first()["n"] == 1
    assert "POWER_GENERATED" in read_archive(spark, path, None).columns


def test_raw_layout(spark, tmp_path):
    header = ",".join(GENERATION_SCHEMA.fieldNames())
    path = write(tmp_path / "g.csv", f"{header}\n15-05-2020 00:00,4135001,k,0.0,0.0,0.0,6259559.0\n")
    row = read_csv(spark, path, GENERATION_SCHEMA).first()
    assert row["PLANT_ID"] == 4135001 and row["TOTAL_YIELD"] == 6259559.0


def test_whole_numbers_with_a_fraction_of_zeros(spark, tmp_path):
    path = write(tmp_path / "w.csv", "N,X,S\n4135001.0,1,a\n7.,2,b\n7.5,3,c\n-3.00,4,d\n")
    assert [r["N"] for r in read_csv(spark, path, SCHEMA).collect()] == [4135001, 7, None, -3]


def test_line_breaks_inside_quotes(spark, tmp_path):
    rows = [(1, 2.5, "two\nlines"), (2, 1.0, 'a\r\n"b", c')]
    path = str(tmp_path / "out")
    write_csv(spark.createDataFrame(rows, SCHEMA).coalesce(1), path)
    assert sorted(tuple(r) for r in read_csv(spark, path, SCHEMA, line_breaks=True).collect()) == rows


def test_rejects_name_every_lost_field(spark, tmp_path):
    path = write(tmp_path / "r.csv", "N,X,S\nx,2.5,ok\n1,NA,ok\n2,y,ok\n3,1.0\n4,1.0,a,b\n5,2.0,z\n")
    got = [(r["COLUMN_NAME"], r["TEXT"], r["REASON"]) for r in csv_rejects(spark, path, SCHEMA).collect()]
    assert got[:2] == [("N", "x", "no int"), ("X", "y", "no double")]
    assert [r[2] for r in got[2:]] == ["wrong number of fields"] * 2


def test_master_table_raises_on_unreadable_times_and_lists_them(spark):
    generation = spark.createDataFrame(
        [(t, 1, "a", 1.0, 1.0, 1.0, 1.0) for t in ("15.05.2020 00:15", "soon", None)], GENERATION_SCHEMA
    )
    weather = spark.createDataFrame([("05/15/2020 12:30 AM", 1, "w", 1.0, 2.0, 3.0)], WEATHER_SCHEMA)
    with pytest.raises(Exception, match="unreadable timestamp: soon"):
        master_table(generation, weather).collect()
    assert master_table(generation, weather, errors="null").count() == 1
    rejects = rejected_times(generation).select("TEXT", "REASON").collect()
    assert sorted(map(tuple, rejects), key=str) == [("soon", "unreadable"), (None, "missing")]
