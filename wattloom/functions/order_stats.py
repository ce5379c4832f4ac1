"""Exact order statistics without sorting the table or filling one task.

``percentile`` keeps every distinct value of a column in one reducer.  Here each
wanted rank is bracketed by a mergeable sketch with bounded rank error, then counted.
Three reads do for up to some 10 ** 12 rows, whatever their values:

1. count, least and greatest value, and a sketch of each column: two values that hold
   the rank between them, with about 4 of 10,000 rows;
2. exact counts below and inside the bracket, and a sketch of the rows inside, which
   gives a bracket of about 2 of 10,000 of these;
3. the rows of the narrow bracket by value, and the count of those before it in the wide
   one, from which the value at the rank follows.

The counts prove a bracket right.  One that is not (numbers beyond the 53 bits that the
sketch keeps), or that still has too many rows, goes on by histograms: a pass counts the
rows of the interval in ``BUCKETS`` buckets of equal width, or of equal ratio after a
pass that hardly narrowed, and the bucket with the rank becomes the next interval.  All
ranks of all columns share the passes, and later passes skip rows outside all intervals,
and row groups too.  Counting combines map-side and its result is spread over the
reducers; the driver sees one small sketch or histogram per interval.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from wattloom.functions.missing import present

CANDIDATE_LIMIT = 65_536
BUCKETS = 4096
SKETCH_ACCURACY = 10_000
# Quantiles that the second sketch is asked for.
_GRID = 8192
_GRID_ACCURACY = 50_000
# Half of a bracket, in rank errors of its sketch.
_MARGIN = 2
# A pass that leaves more than this fraction of the rows calls for other buckets.
POOR_ZOOM = 64

_LARGEST = 1.7976931348623157e308


class Ranked(NamedTuple):
    """A value, the rows below it and the rows equal to it."""

    value: object
    before: int
    copies: int


@dataclass
class _Search:
    """One wanted rank and the closed interval known to hold it.

    ``below`` rows lie under the interval and ``inside`` rows in it.  ``start``, if there
    is one, is a value under the interval from which rows were counted: ``below`` then
    are the rows under it.  ``whole`` is the range of all rows, ``proven`` an interval
    whose rows have been counted.
    """

    column: str
    rank: int
    low: object
    high: object
    inside: int
    below: int = 0
    by_ratio: bool = False
    start: object = None
    whole: tuple = ()
    proven: tuple = ()

    @property
    def interval(self) -> tuple:
        return (self.column, self.low, self.high, self.by_ratio)

    @property
    def found(self) -> bool:
        return self.low == self.high and self.start is None

    def zoom(self, histogram: Sequence[Row]) -> None:
        """Keep the bucket that holds the rank; ``histogram`` is in bucket order."""
        for bucket in histogram:
            if self.rank < self.below + bucket["rows"]:
                self.low, self.high = bucket["least"], bucket["greatest"]
                self.by_ratio = bucket["rows"] * POOR_ZOOM > self.inside and not self.by_ratio
                self.inside = bucket["rows"]
                return
            self.below += bucket["rows"]
        raise ValueError(f"no row of rank {self.rank} in column {self.column}")


def _inside(interval: tuple) -> Column:
    column, low, high, _ = interval
    return F.col(column).between(F.lit(low), F.lit(high))


def _magnitude(value: Column) -> Column:
    """A number that never decreases with the value and grows with its logarithm."""
    # The least positive double has a logarithm above -745.
    size = F.log(F.least(F.abs(value), F.lit(_LARGEST))) + F.lit(746.0)
    return F.when(value == 0, F.lit(0.0)).otherwise(F.signum(value) * size)


def _magnitude_of(value: float) -> float:
    if value == 0:
        return 0.0
    return math.copysign(math.log(min(abs(value), _LARGEST)) + 746.0, value)


def _bucket(interval: tuple) -> Column:
    """Bucket number: never decreases with the value, lies within -1 and BUCKETS + 1."""
    column, low, high, by_ratio = interval
    value = F.col(column)
    if by_ratio:
        floor, top = _magnitude_of(float(low)), _magnitude_of(float(high))
        if top > floor:
            share = (_magnitude(value.cast("double")) - F.lit(floor)) / F.lit(top - floor) * BUCKETS
            share = F.greatest(F.least(share, F.lit(BUCKETS + 1.0)), F.lit(-1.0))
            return F.floor(share).cast("int")
    if isinstance(low, int) and high - low < 2**62:
        offset, width = (value.cast("bigint") - F.lit(low).cast("bigint")).cast("double"), float(high - low)
        return F.floor(offset / F.lit(width) * BUCKETS).cast("int")
    floor, top = max(float(low), -_LARGEST), min(float(high), _LARGEST)
    scale = 1.0 if math.isfinite(top - floor) else 0.5
    offset = value.cast("double") * scale - F.lit(floor * scale)
    share = offset / F.lit(top * scale - floor * scale) * BUCKETS
    if math.isinf(low) or math.isinf(high):
        # Infinite values get the buckets next to the finite ones.
        share = F.greatest(F.least(share, F.lit(BUCKETS + 1.0)), F.lit(-1.0))
    return F.floor(share).cast("int")


def _tagged(values: DataFrame, intervals: Sequence[tuple], extra) -> DataFrame:
    """One row per value and interval that holds it: ``interval``, ``value`` and ``extra``."""
    entries = [
        F.when(
            _inside(interval),
            F.struct(F.lit(i).alias("interval"), *extra(interval), F.col(interval[0]).alias("value")),
        )
        for i, interval in enumerate(intervals)
    ]
    # The plain test on the columns reaches the scan, which then skips row groups.
    near = values.where(reduce(lambda a, b: a | b, map(_inside, intervals)))
    return near.select(F.explode(F.array(*entries)).alias("e")).where("e IS NOT NULL").select("e.*")


def _by_type(values: DataFrame, searches: Sequence[_Search]) -> list[list[_Search]]:
    """Searches grouped by the type of their column, so that values share a column."""
    groups: dict[str, list[_Search]] = {}
    for s in searches:
        groups.setdefault(values.schema[s.column].dataType.simpleString(), []).append(s)
    return list(groups.values())


def _zoom_all(values: DataFrame, searches: Sequence[_Search]) -> None:
    intervals = list(dict.fromkeys(s.interval for s in searches))
    histogram = (
        _tagged(values, intervals, lambda i: [_bucket(i).alias("bucket")])
        .groupBy("interval", "bucket")
        .agg(
            F.count("*").alias("rows"),
            F.min("value").alias("least"),
            F.max("value").alias("greatest"),
        )
    )
    buckets: dict[int, list[Row]] = {}
    # At most BUCKETS + 3 rows per interval.
    for row in histogram.collect():
        buckets.setdefault(row["interval"], []).append(row)
    for s in searches:
        s.zoom(sorted(buckets[intervals.index(s.interval)], key=lambda r: r["bucket"]))


def _pick_all(values: DataFrame, searches: Sequence[_Search]) -> None:
    """Find each rank among the rows of its interval; rows from ``start`` on are counted with them."""
    intervals = list(dict.fromkeys((*s.interval, s.start) for s in searches))
    outer = [(c, low if start is None else start, high, r) for c, low, high, r, start in intervals]
    tagged = _tagged(values, outer, lambda i: [])
    early = reduce(
        lambda a, b: a | b,
        [
            (F.col("interval") == i) & (F.col("value") < F.lit(low))
            for i, (_, low, _, _, _) in enumerate(intervals)
        ],
    )
    # Values under an interval are one group.  At most candidate_limit others of each
    # interval reach this window.
    running = Window.partitionBy("interval").orderBy(F.col("value").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    ranked = (
        tagged.withColumn("value", F.when(~early, F.col("value")))
        .groupBy("interval", "value")
        .agg(F.count("*").alias("copies"))
        .withColumn("upto", F.sum("copies").over(running))
    )
    wanted = F.lit(False)
    for s in searches:
        local = s.rank - s.below
        wanted = wanted | (
            (F.col("interval") == intervals.index((*s.interval, s.start)))
            & (F.col("upto") > local)
            & (F.col("upto") - F.col("copies") <= local)
        )
    # One row per wanted rank.
    hits = ranked.where(wanted & F.col("value").isNotNull()).collect()
    for s in searches:
        number, local = intervals.index((*s.interval, s.start)), s.rank - s.below
        for row in hits:
            if row["interval"] == number and row["upto"] - row["copies"] <= local < row["upto"]:
                s.low = s.high = row["value"]
                s.below += row["upto"] - row["copies"]
                s.inside = row["copies"]
                s.start = None
                break


def _sketch_points(probabilities: Sequence[float], accuracy: int) -> list[float]:
    margin = _MARGIN / accuracy
    return sorted({min(1.0, max(0.0, p + d)) for p in probabilities for d in (-margin, margin)})


def sketch(
    df: DataFrame, column: str, probabilities: Sequence[float], accuracy: int = SKETCH_ACCURACY
) -> Column:
    """Aggregate: values a little before and after each quantile, for :func:`select_ranks`."""
    return F.percentile_approx(present(df, column), _sketch_points(probabilities, accuracy), accuracy)


def _bracket(
    ends: tuple, points: Sequence[float], found: Sequence, rank: int, rows: int, accuracy: int
) -> tuple:
    """The closest values found that hold ``rank`` between them; ``ends`` where there is none."""
    error = 1 / accuracy
    under = [v for p, v in zip(points, found) if p <= rank / rows - error]
    over = [v for p, v in zip(points, found) if p >= (rank + 1) / rows + error]
    return (under[-1] if under else ends[0], over[0] if over else ends[1])


def _narrow_all(values: DataFrame, searches: Sequence[_Search], candidate_limit: int) -> None:
    """Count each bracket, put back those that lack their rank, and narrow those of many rows."""
    brackets = list(dict.fromkeys((s.column, s.low, s.high) for s in searches))
    grid = [i / _GRID for i in range(1, _GRID)]
    # A bracket of the first sketch has at most 2 * (_MARGIN + 1) rank errors of rows, or all rows if these are few.
    many = {
        s.column for s in searches if s.inside * 2 * (_MARGIN + 1) > candidate_limit * SKETCH_ACCURACY
    }
    measures = []
    for i, (column, low, high) in enumerate(brackets):
        value = F.col(column)
        inside = value.between(F.lit(low), F.lit(high))
        measures += [
            F.count_if(value < F.lit(low)).alias(f"below_{i}"),
            F.count_if(inside).alias(f"inside_{i}"),
        ]
        if column in many and low != high:
            found = F.percentile_approx(F.when(inside, value), grid, _GRID_ACCURACY)
            measures.append(found.alias(f"grid_{i}"))
    row = values.agg(*measures).first().asDict()
    for s in searches:
        i = brackets.index((s.column, s.low, s.high))
        below, inside, found = row[f"below_{i}"], row[f"inside_{i}"], row.get(f"grid_{i}")
        if not below <= s.rank < below + inside:
            s.low, s.high = s.whole
            continue
        s.below, s.inside, s.proven = below, inside, (s.low, s.high, inside)
        if inside > candidate_limit and found is not None:
            low, high = _bracket((s.low, s.high), grid, found, s.rank - below, inside, _GRID_ACCURACY)
            expected = inside * (2 / _GRID + 4 / _GRID_ACCURACY)
            if expected <= max(candidate_limit, 1):
                s.start, s.low, s.high, s.inside = s.low, low, high, 0


def column_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple]:
    """Count, minimum and maximum of the present (neither null nor NaN) values."""
    row = df.agg(
        *[
            measure.alias(f"{name}_{i}")
            for i, c in enumerate(columns)
            for name, measure in (
                ("n", F.count(present(df, c))),
                ("min", F.min(present(df, c))),
                ("max", F.max(present(df, c))),
            )
        ]
    ).first()
    return {c: (row[f"n_{i}"], row[f"min_{i}"], row[f"max_{i}"]) for i, c in enumerate(columns)}


def select_ranks(
    df: DataFrame,
    ranks: Mapping[str, Sequence[int]],
    ranges: Mapping[str, tuple],
    candidate_limit: int = CANDIDATE_LIMIT,
    sketches: Mapping[str, tuple[Sequence[float], Sequence]] | None = None,
) -> dict[tuple[str, int], Ranked]:
    """The value at each 0-based rank in ascending order, null and NaN left out.

    ``ranges`` comes from :func:`column_ranges`; ranks must be below its counts.
    ``sketches`` has the probabilities asked for and the values found by :func:`sketch`
    for each column; without it, one more read finds them.  Columns are numeric.
    """
    # NaN is greater than any number and so in no interval.
    values = df.select(*ranks)
    if sketches is None:
        sketches = _sketched(values, {c: [r / ranges[c][0] for r in wanted] for c, wanted in ranks.items()})
    searches = []
    for column, wanted in ranks.items():
        rows, *ends = ranges[column]
        asked, found = sketches[column]
        points = _sketch_points(asked, SKETCH_ACCURACY)
        for rank in sorted(set(wanted)):
            low, high = _bracket(ends, points, found, rank, rows, SKETCH_ACCURACY)
            searches.append(_Search(column, rank, low, high, rows, whole=tuple(ends)))
    _narrow_all(values, searches, candidate_limit)
    for group in _by_type(values, searches):
        _zoom_and_pick(values, group, candidate_limit)
        # A bracket of the second sketch without its rank: go on from the first one.
        if lost := [s for s in group if s.start is not None]:
            for s in lost:
                s.low, s.high, s.inside = s.proven
                s.start = None
            _zoom_and_pick(values, lost, candidate_limit)
    return {(s.column, s.rank): Ranked(s.low, s.below, s.inside) for s in searches}


def _zoom_and_pick(values: DataFrame, searches: Sequence[_Search], candidate_limit: int) -> None:
    while wide := [s for s in searches if not s.found and s.inside > candidate_limit]:
        _zoom_all(values, wide)
    if narrow := [s for s in searches if not s.found]:
        _pick_all(values, narrow)


def _sketched(df: DataFrame, probabilities: Mapping[str, Sequence[float]]) -> dict[str, tuple]:
    """For each column, the probabilities and what :func:`sketch` finds for them."""
    found = df.agg(*[sketch(df, c, p).alias(f"sketch_{i}") for i, (c, p) in enumerate(probabilities.items())])
    row = found.first()
    return {c: (p, row[f"sketch_{i}"]) for i, (c, p) in enumerate(probabilities.items())}


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    ranges: Mapping[str, tuple] | None = None,
    candidate_limit: int = CANDIDATE_LIMIT,
    sketches: Mapping[str, Sequence] | None = None,
) -> dict[tuple[str, float], float | None]:
    """Quantiles with linear interpolation between neighbouring values.

    ``ranges`` and ``sketches`` (what :func:`sketch` finds for ``probabilities``) spare a
    read each if they come from an earlier one.
    """
    if ranges is None and sketches is None:
        ranges, sketches = _ranges_and_sketches(df, columns, probabilities)
    ranges = ranges or column_ranges(df, columns)
    position = {
        (c, p): p * (ranges[c][0] - 1) for c in columns for p in probabilities if ranges[c][0] > 0
    }
    ranks: dict[str, list[int]] = {}
    for (c, _), at in position.items():
        ranks.setdefault(c, []).extend([math.floor(at), math.ceil(at)])
    own = None if sketches is None else {c: (probabilities, sketches[c]) for c in ranks}
    found = select_ranks(df, ranks, ranges, candidate_limit, own) if ranks else {}
    result: dict[tuple[str, float], float | None] = {}
    for c in columns:
        for p in probabilities:
            at = position.get((c, p))
            if at is None:
                result[(c, p)] = None
                continue
            share = at - math.floor(at)
            low, high = (
                float(v) if isinstance(v, Decimal) else v
                for v in (found[(c, math.floor(at))].value, found[(c, math.ceil(at))].value)
            )
            result[(c, p)] = low if low == high else low * (1.0 - share) + high * share
    return result


def _ranges_and_sketches(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> tuple[dict[str, tuple], dict[str, Sequence]]:
    """What :func:`column_ranges` and :func:`sketch` find, in one read."""
    measures = [
        measure.alias(f"{name}_{i}")
        for i, c in enumerate(columns)
        for name, measure in (
            ("n", F.count(present(df, c))),
            ("min", F.min(present(df, c))),
            ("max", F.max(present(df, c))),
            ("sketch", sketch(df, c, probabilities)),
        )
    ]
    row = df.agg(*measures).first()
    ranges = {c: (row[f"n_{i}"], row[f"min_{i}"], row[f"max_{i}"]) for i, c in enumerate(columns)}
    return ranges, {c: row[f"sketch_{i}"] for i, c in enumerate(columns)}


def approximate_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    accuracy: int = SKETCH_ACCURACY,
) -> dict[tuple[str, float], float | None]:
    """One-pass quantiles from a bounded sketch; rank error at most ``1/accuracy``."""
    row = df.agg(
        *[
            F.percentile_approx(present(df, c), list(probabilities), accuracy).alias(c)
            for c in columns
        ]
    ).first()
    return {
        (c, p): (row[c][i] if row[c] is not None else None)
        for c in columns
        for i, p in enumerate(probabilities)
    }
