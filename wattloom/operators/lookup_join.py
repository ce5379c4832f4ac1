"""Equi-join of a large fact table with a lookup that has one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.workspace import materialize

# Broadcast only up to this size; beyond it the join shuffles.
BROADCAST_BYTES = 64 * 1024 * 1024
# A key is hot when it holds more than this share of the facts, so there are
# never more than 1 / HOT_SHARE of them.
HOT_SHARE = 0.001


def table_bytes(df: DataFrame) -> int:
    """Row data size of ``df``: fixed-width columns at 8 bytes, text at its length."""
    texts = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))
    ]
    row_width = 16 + 8 * len(df.columns)
    text_size = [F.sum(F.octet_length(F.col(c))) for c in texts]
    row = df.agg(F.count("*"), *text_size).first()
    return row[0] * row_width + sum(size or 0 for size in row[1:])


def hot_keys(facts: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold more than ``share`` of the rows: at most ``1 / share`` keys.

    The counts are stored, so the facts are read once for them.
    """
    counted = facts.groupBy(*keys).agg(F.count("*").alias("_n"))
    counts = materialize(counted.dropna(subset=list(keys)), "keycounts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    return counts.where(F.col("_n") > total * share).select(*keys)


_RANGED = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)


def key_range(lookup: DataFrame, key: str) -> tuple[Column, Column] | None:
    """Least and greatest key as literals, or None if no row has the key."""
    kind = lookup.schema[key].dataType
    # Times pass the driver as numbers or text, so that no time zone of its own comes in.
    if isinstance(kind, T.TimestampType):
        sent, back = F.unix_micros, F.timestamp_micros
    elif isinstance(kind, (T.TimestampNTZType, T.DateType)):
        sent, back = (lambda c: c.cast("string")), (lambda c: c.cast(kind))
    else:
        sent, back = (lambda c: c), (lambda c: c.cast(kind))
    ends = lookup.agg(sent(F.min(key)).alias("low"), sent(F.max(key)).alias("high")).first()
    return None if ends["low"] is None else (back(F.lit(ends["low"])), back(F.lit(ends["high"])))


def within_key_ranges(facts: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The facts whose keys lie within the range of the lookup's keys, as plain literals.

    Keys of other types than numbers, texts, dates and times have no such test.
    """
    for key in keys:
        if isinstance(lookup.schema[key].dataType, _RANGED):
            ends = key_range(lookup, key)
            if ends is None:
                return facts.where(F.lit(False))
            facts = facts.where(F.col(key).between(*ends))
    return facts


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
    lookup_stored: bool = False,
    facts_stored: bool = False,
    prune: bool = True,
) -> DataFrame:
    """Join ``facts`` to ``lookup`` on ``keys``; ``how`` is ``inner`` or ``left``.

    The lookup is stored once (unless ``lookup_stored`` says it is cheap to read) and
    measured.  A small one is broadcast and the facts never move.  Beyond that the facts
    are stored, since they are read several times, and their rows part ways: those of
    hot keys meet the few lookup rows of these keys by broadcast, those with a missing key
    match nothing and do not move either, and only the others are shuffled.  No key among
    them is hot, and adaptive execution splits what is still uneven.  ``facts_stored`` says
    that the facts are cheap to read again.

    An inner join keeps only facts whose keys lie within the lookup's least and greatest;
    these reach the scan, which skips row groups, and spare the others the shuffle.
    ``prune=False`` leaves that out: a test on a key that is parsed from text would parse
    it once more.
    """
    keys = list(keys)
    stored = lookup if lookup_stored else materialize(lookup, "lookup")
    if how == "inner" and prune:
        facts = within_key_ranges(facts, stored, keys)
    if table_bytes(stored) <= broadcast_bytes:
        return facts.join(F.broadcast(stored), keys, how)

    if not facts_stored:
        facts = materialize(facts, "facts")
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    keyed = facts.where(~no_key)
    # Bounded by 1 / hot_share rows, and as many of the lookup, which has one row per key.
    hot = materialize(hot_keys(keyed, keys, hot_share), "hot")
    hot_lookup = stored.join(F.broadcast(hot), keys, "left_semi")
    joined = (
        keyed.join(F.broadcast(hot), keys, "left_semi").join(F.broadcast(hot_lookup), keys, how)
    ).unionByName(
        keyed.join(F.broadcast(hot), keys, "left_anti").join(stored.hint("merge"), keys, how)
    )
    if how == "left":
        joined = joined.unionByName(facts.where(no_key), allowMissingColumns=True)
    return joined
