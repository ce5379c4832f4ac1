"""Column helpers: evaluate once, running sums, words."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.operators.lookup_join import BROADCAST_BYTES

_STEP = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(numbers: Column) -> Column:
    """Sum of an array of longs."""
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def running_starts(lengths: Column) -> Column:
    """For each entry of an array of longs, the sum of the entries before it.

    Sums go over blocks first, so an array of n entries takes n * sqrt(n) steps or so.
    """

    def starts(own: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(own) - 1) / _STEP).cast("int")),
            lambda b: total(F.slice(own, b * _STEP + 1, F.lit(_STEP))),
        )
        return let(
            blocks,
            lambda sums: F.transform(
                F.sequence(F.lit(0), F.size(own) - 1),
                lambda i: total(F.slice(sums, F.lit(1), F.floor(i / _STEP).cast("int")))
                + total(
                    F.slice(own, (F.floor(i / _STEP) * _STEP + 1).cast("int"), i % _STEP)
                ),
            ),
        )

    empty = F.array().cast("array<bigint>")
    return let(lengths, lambda own: F.when(F.size(own) > 0, starts(own)).otherwise(empty))


def chosen_by_hash(share: float, *columns: Column | str) -> Column:
    """True for about ``share`` of the rows, by a hash of the columns.

    Unlike the rows of least hash, these are found without any task passing on more
    rows than it has among them.
    """
    if share >= 1:
        return F.lit(True)
    return F.xxhash64(*columns) < F.lit(int(-(2**63) + share * 2**64)).cast("long")


def words_of(text: Column) -> Column:
    """Lower-cased runs of characters other than ASCII white space."""
    return F.array_remove(F.split(F.lower(text), "[\\x20\\t-\\r]+"), "")


def _varies(kind: T.DataType) -> bool:
    """Arrays, and structs with texts or arrays, whose size is not in their type."""
    if isinstance(kind, T.StructType):
        flat = (T.StringType, T.BinaryType, T.ArrayType)
        return any(isinstance(f.dataType, flat) or _varies(f.dataType) for f in kind.fields)
    return isinstance(kind, T.ArrayType)


def _bytes(value: Column, kind: T.DataType) -> Column:
    """Bytes of a value: 8 for a number, texts and arrays by their length."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 8
    if isinstance(kind, T.ArrayType) and _varies(kind.elementType):
        return F.coalesce(total(F.transform(value, lambda x: _bytes(x, kind.elementType).cast("long"))), F.lit(0)) + 16
    if isinstance(kind, T.StructType) and _varies(kind):
        return sum((_bytes(value[f.name], f.dataType) for f in kind.fields), F.lit(8))
    if isinstance(kind, T.ArrayType):
        width = 8 * len(kind.elementType) if isinstance(kind.elementType, T.StructType) else 8
        return F.coalesce(F.size(value), F.lit(0)) * (width + 8) + 16
    return F.lit(8)


def if_small(df: DataFrame) -> DataFrame:
    """A stored table of numbers, texts, arrays and structs; marked for broadcast if it measures small."""
    row = sum((_bytes(F.col(f.name), f.dataType) for f in df.schema.fields), F.lit(16))
    measured = df.agg(F.sum(row.cast("long"))).first()[0] or 0
    return F.broadcast(df) if measured <= BROADCAST_BYTES else df
