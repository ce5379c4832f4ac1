import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from decimal import Decimal

from pyspark.sql import functions as F

from wattloom.functions import order_stats
from wattloom.operators.profile import iqr_bounds
from wattloom.workspace import materialize
from wattloom.functions.order_stats import (
    approximate_quantiles,
    column_ranges,
    exact_quantiles,
    select_ranks,
)

PROBABILITIES = [0.0, 0.25, 0.5, 0.8, 1.0]


def doubles(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


def check(spark, values, limit):
    present = sorted(v for v in values if v is not None and not math.isnan(v))
    got = exact_quantiles(doubles(spark, values), ["x"], PROBABILITIES, candidate_limit=limit)
    for p in PROBABILITIES:
        if not present:
            assert got[("x", p)] is None
        else:
            assert got[("x", p)] == pytest.approx(np.quantile(present, p), rel=1e-12, abs=1e-300)


@pytest.mark.parametrize("limit", [1, 5, 100_000])
@pytest.mark.parametrize(
    "values",
    [
        [1.0],
        [2.0, 1.0],
        [3.0] * 50,
        [0.0] * 40 + [1.0] * 40,
        [float(i % 7) for i in range(200)],
        [1e-300, 1e300, -1e300, 5.0, 5.0, 6.0, 7.0, -1e-300],
        [1.7e308, -1.7e308, 1.0, 2.0, 3.0],
        [5e-324, 0.0, 1e-323, 1.5e-323, 2e-323],
        [None, float("nan"), 4.0, None, 2.0, float("nan"), 9.0],
        [None, float("nan")],
        list(np.random.default_rng(1).exponential(50, 500)),
    ],
)
def test_equals_numpy(spark, values, limit):
    check(spark, values, limit)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.floats(-1e9, 1e9, allow_nan=False), min_size=1, max_size=60),
    st.sampled_from([1, 3, 10]),
)
def test_equals_numpy_on_any_list(spark, values, limit):
    check(spark, values, limit)


def test_infinite_values_are_ranked(spark):
    inf = float("inf")
    df = doubles(spark, [inf, -inf, inf, 1.0, 2.0, -inf, 3.0, 4.0])
    ranges = column_ranges(df, ["x"])
    got = select_ranks(df, {"x": range(8)}, ranges, candidate_limit=1)
    assert [got[("x", i)].value for i in range(8)] == [-inf, -inf, 1.0, 2.0, 3.0, 4.0, inf, inf]


@pytest.mark.parametrize("limit", [1, 4, 1000])
def test_ranks_of_large_integers_with_counts(spark, limit):
    base = 2**60
    values = [base, base + 1, base + 1, base + 2, base + 500, -base, 7, 7, 7, 8]
    df = spark.createDataFrame([(v,) for v in values], "x bigint")
    got = select_ranks(df, {"x": range(len(values))}, column_ranges(df, ["x"]), limit)
    ordered = sorted(values)
    for rank, value in enumerate(ordered):
        found = got[("x", rank)]
        assert found.value == value
        assert found.before == ordered.index(value)
        assert found.copies == ordered.count(value)


def test_columns_of_different_types_share_a_call(spark):
    df = spark.createDataFrame([(i, float(i) / 2) for i in range(101)], "a bigint, b double")
    got = exact_quantiles(df, ["a", "b"], [0.25], candidate_limit=10)
    assert got == {("a", 0.25): 25, ("b", 0.25): 12.5}


def test_approximate_quantiles_stay_within_their_error(spark):
    df = doubles(spark, range(10_001))
    got = approximate_quantiles(df, ["x"], [0.25, 0.75], accuracy=1000)
    assert abs(got[("x", 0.25)] - 2500) <= 11
    assert abs(got[("x", 0.75)] - 7500) <= 11


def test_wide_whole_numbers(spark):
    values = [-2_000_000_000 + 40_000 * i for i in range(100_001)]
    df = spark.createDataFrame([(v,) for v in values], "x int")
    got = exact_quantiles(df, ["x"], [0.25, 0.5], candidate_limit=100)
    assert got == {("x", 0.25): -1_000_000_000.0, ("x", 0.5): 0.0}


@pytest.mark.parametrize("n", [100, 101])
def test_decimals(spark, n):
    df = spark.createDataFrame([(Decimal(i) / 4,) for i in range(n)], "x decimal(12,2)")
    got = exact_quantiles(df, ["x"], [0.25], candidate_limit=10)
    assert got[("x", 0.25)] == pytest.approx((n - 1) / 16)
    low, high = iqr_bounds(df, ["x"])["x"]
    assert low < 0 < high


def test_few_passes_over_many_orders_of_magnitude(spark, monkeypatch):
    passes = []
    for name in ("_zoom_all", "_pick_all"):
        original = getattr(order_stats, name)
        monkeypatch.setattr(
            order_stats, name, lambda v, s, o=original, n=name: (passes.append(n), o(v, s))[1]
        )
    df = spark.range(20_000).select(F.pow(F.lit(10.0), F.col("id") / 20_000 * 600 - 300).alias("x"))
    got = exact_quantiles(df, ["x"], [0.5], candidate_limit=100)
    assert got[("x", 0.5)] == pytest.approx(10 ** (-0.015), rel=0.1)
    assert len(passes) <= 4


def test_later_passes_skip_rows_in_the_scan(spark):
    df = materialize(spark.range(1000).select(F.col("id").cast("double").alias("x")), "numbers")
    tagged = order_stats._tagged(df, [("x", 10.0, 20.0, False)], lambda i: [])
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(x,10.0)" in plan
    assert tagged.count() == 11


def even(spark, n):
    return spark.range(n).select((F.col("id") * 7919 % n).cast("double").alias("x"))


def decades(spark, n):
    return spark.range(n).select(F.pow(F.lit(10.0), F.col("id") / n * 600 - 300).alias("x"))


def clusters(spark, n):
    far = F.when(F.col("id") % 2 == 0, 0.0).otherwise(1e15)
    return spark.range(n).select((far + F.col("id") / n).alias("x"))


def ties(spark, n):
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") / 7).alias("x"))


@pytest.mark.parametrize("build", [even, decades, clusters, ties])
@pytest.mark.parametrize("limit", [40, 65_536])
def test_three_reads_whatever_the_values(spark, monkeypatch, build, limit):
    n = 120_000
    df = materialize(build(spark, n), "numbers")
    values = np.sort(np.array([r["x"] for r in df.collect()]))
    reads = []
    for name in ("_ranges_and_sketches", "_sketched", "_narrow_all", "_zoom_all", "_pick_all"):
        original = getattr(order_stats, name)
        monkeypatch.setattr(order_stats, name, lambda *a, o=original, n=name: (reads.append(n), o(*a))[1])
    got = exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.8, 1.0], candidate_limit=limit)
    assert len(reads) <= 3, reads
    for p in (0.0, 0.25, 0.5, 0.8, 1.0):
        assert got[("x", p)] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_counts_come_with_narrow_brackets(spark):
    df = materialize(ties(spark, 60_000), "numbers")
    values = sorted(r["x"] for r in df.collect())
    ranks = [0, 10, 30_000, 59_999, values.index(5.0), values.index(5.0) + 1000]
    got = select_ranks(df, {"x": ranks}, column_ranges(df, ["x"]), candidate_limit=10)
    for rank in ranks:
        value = values[rank]
        assert tuple(got[("x", rank)]) == (value, values.index(value), values.count(value))


def test_wrong_sketches_are_found_out(spark):
    df = materialize(even(spark, 5_000), "numbers")
    ranges = column_ranges(df, ["x"])
    for values in ([10.0, 20.0], [4_000.0, 4_100.0]):
        got = select_ranks(df, {"x": [2_500]}, ranges, 50, {"x": ([0.5], values)})
        assert tuple(got[("x", 2_500)]) == (2_500.0, 2_500, 1)


def test_histograms_without_a_sketch(spark):
    df = materialize(decades(spark, 5_000), "numbers")
    values = sorted(r["x"] for r in df.collect())
    search = order_stats._Search("x", 1_234, values[0], values[-1], len(values))
    order_stats._zoom_and_pick(df, [search], 20)
    assert (search.low, search.below, search.inside) == (values[1_234], 1_234, 1)
