import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wattloom.functions.ranking import with_global_index
from wattloom.operators.lookup_join import hot_keys, lookup_join, table_bytes
from wattloom.operators.prepare import (
    build_master,
    calendar_features,
    finalize_features,
    hourly_weather,
    label_encode,
    union_sources,
)
from wattloom.plans.offline import feature_table, load_plants, master_table
from wattloom.workspace import materialize

NAN = float("nan")


def at(hour, minute=0):
    return datetime(2020, 5, 15, hour, minute)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_union_matches_columns_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2)], "b string, a int")
    c = spark.createDataFrame([(3,)], "a int")
    assert rows(union_sources(a, b, c)) == [(1, "x"), (2, "y"), (3, None)]


def test_hourly_weather_skips_missing_keys_and_values(spark):
    weather = spark.createDataFrame(
        [
            (at(1, 5), 1, 10.0, 1.0, NAN),
            (at(1, 50), 1, None, 3.0, NAN),
            (at(2), 1, NAN, None, 0.5),
            (None, 1, 5.0, 5.0, 5.0),
            (at(1), None, 5.0, 5.0, 5.0),
        ],
        "DATE_TIME timestamp, PLANT_ID int, AMBIENT_TEMPERATURE double, "
        "MODULE_TEMPERATURE double, IRRADIATION double",
    )
    assert rows(hourly_weather(weather)) == [
        (at(1), 1, 10.0, 2.0, None),
        (at(2), 1, None, None, 0.5),
    ]


@pytest.fixture
def tables(spark):
    generation = spark.createDataFrame(
        [
            (at(1, 0), 1, "a"),
            (at(1, 15), 1, "a"),
            (at(1, 30), 2, "b"),
            (at(3, 0), 1, "a"),
            (None, 1, "a"),
            (at(1), None, "a"),
        ],
        "DATE_TIME timestamp, PLANT_ID int, SOURCE_KEY string",
    )
    weather = spark.createDataFrame(
        [(at(1), 1, 0.1), (at(1), 2, 0.2), (at(2), 1, 0.3)],
        "DATE_TIME timestamp, PLANT_ID int, IRRADIATION double",
    )
    return generation, weather


@pytest.mark.parametrize("broadcast_bytes", [0, 10**9])
def test_master_keeps_every_reading_with_weather(tables, broadcast_bytes):
    generation, weather = tables
    master = build_master(generation, weather, broadcast_bytes=broadcast_bytes)
    assert rows(master) == [
        (at(1), 1, "a", 0.1),
        (at(1), 1, "a", 0.1),
        (at(1), 2, "b", 0.2),
    ]


def test_master_can_keep_the_original_time(tables):
    generation, weather = tables
    master = build_master(generation, weather, keep_original_time=True)
    assert sorted(r["ORIGINAL_TIME"] for r in master.collect()) == [at(1), at(1, 15), at(1, 30)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_shuffled_join_of_hot_and_missing_keys(spark, how):
    n = 3000
    facts = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("key"),
        "id",
    )
    lookup = spark.createDataFrame(
        [("hot", 1.0)] + [(f"k{i}", float(i)) for i in range(0, n, 2)], "key string, v double"
    )
    plain = facts.join(lookup, "key", how).select("key", "id", "v")
    shuffled = lookup_join(facts, lookup, ["key"], how, broadcast_bytes=0, hot_share=0.1)
    assert rows(shuffled.select("key", "id", "v")) == rows(plain)
    plan = shuffled._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan


def test_equal_rows_do_not_meet_in_one_task(spark):
    """Only a key column, half of it one key and a quarter missing."""
    n = 40_000
    i = F.col("id")
    facts = spark.range(n).select(
        F.when(i % 2 == 0, F.lit("hot")).when(i % 4 == 1, F.lit(None)).otherwise(i.cast("string")).alias("key")
    )
    lookup = facts.dropna().distinct().withColumn("v", F.length("key"))
    joined = lookup_join(facts, lookup, ["key"], "left", broadcast_bytes=0)
    sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == n
    assert joined.where("v IS NULL").count() == n // 4
    shuffled = [line for line in str(joined._jdf.queryExecution().executedPlan()).split("\n") if "hashpartitioning(key" in line]
    assert shuffled
    # The shuffled branch holds neither the hot nor the missing keys.
    assert max(r["count"] for r in sizes) <= n // 2


def test_small_lookup_is_broadcast_and_facts_do_not_move(spark):
    facts = spark.range(100).withColumn("key", F.col("id") % 5)
    lookup = spark.range(5).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    plan = lookup_join(facts, lookup, ["key"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_hot_keys_are_bounded(spark):
    facts = spark.range(10_000).withColumn(
        "key", F.when(F.col("id") < 4000, F.lit(-1)).otherwise(F.col("id"))
    )
    assert rows(hot_keys(facts, ["key"])) == [(-1,)]


def test_table_bytes_counts_text(spark):
    small = spark.createDataFrame([("a", 1)], "s string, n int")
    large = spark.createDataFrame([("a" * 1000, 1)], "s string, n int")
    assert table_bytes(large) - table_bytes(small) == 999
    assert table_bytes(small.limit(0)) == 0


@pytest.mark.parametrize("broadcast_bytes", [0, 10**9])
def test_label_codes_follow_code_point_order(spark, broadcast_bytes):
    values = ["b", "a", "B", "é", "a", "Z", None, "aa", ""]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {
        (r["i"], r["s"]): r["s_ENCODED"]
        for r in label_encode(df, "s", broadcast_bytes=broadcast_bytes).collect()
    }
    order = sorted({v for v in values if v is not None})
    assert got == {(i, v): (None if v is None else order.index(v)) for i, v in enumerate(values)}


def test_global_index_is_the_sorted_position(spark):
    df = spark.range(5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("v"))
    indexed = with_global_index(df, ["v"])
    assert indexed.where("v <> ROW_INDEX").count() == 0
    assert indexed.count() == 5000


def test_global_index_of_equal_rows_uses_several_partitions(spark):
    df = spark.range(20_000, numPartitions=4).select(F.lit(1).alias("v"))
    indexed = with_global_index(df, ["v"])
    assert [r[0] for r in indexed.orderBy("ROW_INDEX").select("ROW_INDEX").collect()] == list(
        range(20_000)
    )


def test_calendar_and_final_features(spark):
    df = spark.createDataFrame([(datetime(2024, 2, 29, 13, 30), 8.0)], "DATE_TIME timestamp, AC double")
    row = finalize_features(calendar_features(df), F.col("AC") / 2).first().asDict()
    assert row == {
        "DATE_TIME": datetime(2024, 2, 29, 13, 30),
        "AC": 8.0,
        "HOUR": 13,
        "DAY": 29,
        "MONTH": 2,
        "DAY_NAME": "Thursday",
        "IS_WEEKEND": 0,
        "YEAR": 2024,
        "DAY_OF_WEEK": 3,
        "POWER_GENERATED": 4.0,
    }


def test_raw_files_to_features(spark, tmp_path):
    def write(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    generation_header = "DATE_TIME,PLANT_ID,SOURCE_KEY,DC_POWER,AC_POWER,DAILY_YIELD,TOTAL_YIELD\n"
    weather_header = (
        "DATE_TIME,PLANT_ID,SOURCE_KEY,AMBIENT_TEMPERATURE,MODULE_TEMPERATURE,IRRADIATION\n"
    )
    generation, weather = load_plants(
        spark,
        [
            write(
                "g1.csv",
                generation_header
                + "15-05-2020 06:00,1,inv-b,10.0,9.0,1.0,100.0\n"
                + "15-05-2020 06:15,1,inv-b,10.0,9.0,1.0,100.0\n"
                + "15-05-2020 07:00,1,inv-a,20.0,18.0,2.0,102.0\n",
            ),
            write(
                "g2.csv", generation_header + "2020-05-15 06:00:00,2,inv-c,5.0,4.0,1.0,50.0\n"
            ),
        ],
        [
            write(
                "w1.csv",
                weather_header
                + "2020-05-15 06:00:00,1,s,20.0,30.0,0.5\n"
                + "2020-05-15 06:45:00,1,s,22.0,32.0,NA\n",
            ),
            write("w2.csv", weather_header + "2020-05-15 06:30:00,2,t,25.0,35.0,0.7\n"),
        ],
    )
    master = master_table(generation, weather)
    assert master.count() == 3
    features = feature_table(master, F.col("AC_POWER"))
    got = {
        r["SOURCE_KEY"]: (
            r["DATE_TIME"],
            r["AMBIENT_TEMPERATURE"],
            r["IRRADIATION"],
            r["SOURCE_KEY_ENCODED"],
            r["DAY_NAME"],
            r["DAY_OF_WEEK"],
            r["POWER_GENERATED"],
        )
        for r in features.collect()
    }
    # The two readings of 06:00 and 06:15 fall together once floored to the hour.
    assert features.count() == 2
    assert got == {
        "inv-b": (at(6), 21.0, 0.5, 0, "Friday", 4, 9.0),
        "inv-c": (at(6), 25.0, 0.7, 1, "Friday", 4, 4.0),
    }


def pushed(df):
    conf = df.sparkSession.conf
    before = conf.get("spark.sql.maxMetadataStringLength")
    conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        conf.set("spark.sql.maxMetadataStringLength", before)
    return " ".join(re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan))


@pytest.mark.parametrize("broadcast_bytes", [64 * 1024 * 1024, 0])
def test_key_ranges_reach_the_scan_of_the_facts(spark, broadcast_bytes):
    facts = spark.range(1000).select(
        F.col("id").alias("key"), F.concat(F.lit("k"), F.col("id") % 10).alias("name"), F.lit(1.0).alias("x")
    )
    facts = materialize(facts, "facts")
    lookup = spark.range(200, 300).select(
        F.col("id").alias("key"), F.concat(F.lit("k"), F.col("id") % 10).alias("name"), F.col("id").alias("y")
    )
    joined = lookup_join(
        facts, lookup.where("name <= 'k4'"), ["key", "name"], broadcast_bytes=broadcast_bytes, facts_stored=True
    )
    assert joined.count() == 50
    text = pushed(joined)
    assert "GreaterThanOrEqual(key,200)" in text and "LessThanOrEqual(key,294)" in text
    assert "LessThanOrEqual(name,k4)" in text
    outer = lookup_join(facts, lookup, ["key", "name"], "left", broadcast_bytes=broadcast_bytes, facts_stored=True)
    assert outer.count() == 1000
    none = lookup_join(facts, lookup.where("key < 0"), ["key", "name"], broadcast_bytes=broadcast_bytes)
    assert none.count() == 0 and none.columns == ["key", "name", "x", "y"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_hours_of_the_weather_reach_the_scan_of_the_readings(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        hours = spark.sql("SELECT explode(sequence(0, 71)) AS h")
        # The night in which clocks are set back in one of the zones.
        at = F.to_timestamp(F.lit("2024-11-02 00:00:00")) + F.make_interval(hours="h", mins=F.lit(30))
        generation = materialize(hours.select(at.alias("DATE_TIME"), F.lit(1).alias("PLANT_ID"), "h"), "readings")
        weather = generation.where("h BETWEEN 20 AND 30").select(
            "DATE_TIME", "PLANT_ID", *[F.lit(1.0).alias(m) for m in ("AMBIENT_TEMPERATURE", "MODULE_TEMPERATURE", "IRRADIATION")]
        )
        master = build_master(generation, hourly_weather(weather))
        text = pushed(master)
        assert sorted(r["h"] for r in master.collect()) == list(range(20, 31))
        assert "GreaterThanOrEqual(DATE_TIME," in text and "LessThan(DATE_TIME," in text
        assert "LessThanOrEqual(PLANT_ID,1)" in text
        none = build_master(generation, hourly_weather(weather.limit(0)))
        assert none.count() == 0 and none.columns == master.columns
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
