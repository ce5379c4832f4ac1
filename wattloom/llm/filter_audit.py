"""Audit of quality filters in every order: what each step removes, and what it costs.

Filters either pass or fail a document, whatever came before, so a document's fate under
any order of the filters follows from the set of filters it fails, its *mask*.  Documents
are counted by mask and labels where they lie; each mask stands for one big integer whose
64-bit fields hold the outcomes of all steps of all orders, and a part's report is the sum
of its documents' integers, unpacked once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.columns import if_small, let

FILTERS = "ABCDE"
# Steps count documents of a part in fields of this width, so no sum of rows can overflow.
FIELD_BITS = 64
COUNTERS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
REPORT_SCHEMA = (
    "part string, filter_order string, step int, "
    + ", ".join(f"{c} long" for c in COUNTERS)
    + ", shapley long"
)
_SPACES = "[\\x20\\t-\\r]+"
# The last filter compares texts with those of other documents.
_COPY_BIT = 1 << FILTERS.index("E")


def text_mask(text: Column) -> Column:
    """Bits of the filters A to D that a text fails; a null text is an empty one."""
    own = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(own, _SPACES), "")
    sizes = let(words, lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))
    few_words = lambda s: s["n"] < 50
    repetitive = lambda s: F.lit(100) * s["d"] < F.lit(65) * s["n"]
    capitals = F.lit(100) * F.regexp_count(own, F.lit("[A-Z]")) > F.lit(5) * F.length(own)
    symbols = own.rlike("[#$%&*|]")
    bit = lambda fails, letter: F.when(fails, 1 << FILTERS.index(letter)).otherwise(0)
    return let(
        sizes, lambda s: bit(few_words(s), "A") + bit(repetitive(s), "B")
    ) + bit(capitals, "C") + bit(symbols, "D")


def _with_labels(facts: DataFrame, labels: DataFrame) -> DataFrame:
    """``good`` and ``toxic`` of each row; only labels that say 1 are joined, one row an id."""
    said = (
        labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)")
        .groupBy("doc_id")
        .agg(F.max(F.expr("quality = 1")).alias("good"), F.max(F.expr("toxic = 1")).alias("toxic"))
    )
    named = facts.where("doc_id IS NOT NULL").join(if_small(said), "doc_id", "left")
    flags = {c: F.coalesce(F.col(c), F.lit(False)) for c in ("good", "toxic")}
    unnamed = facts.where("doc_id IS NULL").withColumns({c: F.lit(False) for c in flags})
    return named.withColumns(flags).unionByName(unnamed)


def counted_masks(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, good, toxic, n``: documents of a part by the filters they fail.

    Copies meet by the SHA-256 of their text.  Rows of a text are first counted by id and
    state, then by state, and only then by text alone, so a text that a third of all rows
    share leaves its tasks as a few counts.
    """
    facts = documents.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"),
        text_mask(F.col("text")).alias("mask"),
    )
    state = ["part", "mask", "good", "toxic"]
    by_id = _with_labels(facts, labels).groupBy("digest", *state, "doc_id").agg(F.count("*").alias("n"))
    by_state = by_id.groupBy("digest", *state).agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("least"),
        F.min_by("n", "doc_id").alias("n_least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_unnamed"),
    )
    # At most one row for each part and set of failed filters in a window.
    by_state = by_state.withColumn("first", F.min("least").over(Window.partitionBy("digest")))
    is_first = F.col("least") == F.col("first")
    originals = F.when(is_first, F.col("n_least")).otherwise(0) + F.col("n_unnamed")
    passing = F.struct(F.col("mask"), originals.alias("n"))
    failing = F.struct((F.col("mask") + _COPY_BIT).alias("mask"), (F.col("n") - originals).alias("n"))
    return (
        by_state.select("part", "good", "toxic", F.explode(F.array(passing, failing)).alias("of"))
        .select("part", "good", "toxic", "of.*")
        .where("n > 0")
        .groupBy(*state)
        .agg(F.sum("n").alias("n"))
    )


@lru_cache(maxsize=1)
def orders() -> list[str]:
    """All orders of the filters, alphabetically."""
    return ["".join(p) for p in permutations(FILTERS)]


@lru_cache(maxsize=None)
def packed_outcomes(mask: int, good: bool, toxic: bool) -> int:
    """The outcomes of one document at every step of every order, one 64-bit field each.

    Fields run over orders, then steps, then :data:`COUNTERS`.
    """
    outcomes = np.zeros((len(orders()), len(FILTERS), len(COUNTERS)), "<u8")
    for row, order in zip(outcomes, orders()):
        gone = False
        for step, letter in zip(row, order):
            bit = 1 << FILTERS.index(letter)
            fails = bool(mask & bit)
            removed = fails and not gone
            gone = gone or fails
            step[:] = [not gone, removed, fails and not removed, mask == bit, removed and good, removed and toxic]
    return int.from_bytes(outcomes.tobytes(), "little")


def unpacked(total: int) -> np.ndarray:
    """Counters by order and step from a sum of :func:`packed_outcomes`."""
    shape = (len(orders()), len(FILTERS), len(COUNTERS))
    size = int(np.prod(shape)) * FIELD_BITS // 8
    return np.frombuffer(total.to_bytes(size, "little"), "<u8").reshape(shape).astype(np.int64)


def _report(part: str, total: int) -> pd.DataFrame:
    counters = unpacked(total)
    removed = counters[:, :, COUNTERS.index("removed")]
    letters = np.array([list(order) for order in orders()])
    shapley = {letter: int(removed[letters == letter].sum()) for letter in FILTERS}
    rows = len(orders()) * len(FILTERS)
    table = pd.DataFrame(counters.reshape(rows, len(COUNTERS)), columns=COUNTERS)
    table.insert(0, "part", part)
    table.insert(1, "filter_order", np.repeat(orders(), len(FILTERS)))
    table.insert(2, "step", np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(orders())))
    table["shapley"] = [shapley[x] for x in letters.ravel()]
    return table


def _reports(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for part, counts in zip(batch["part"], batch["counts"]):
            yield _report(part, sum(c["n"] * packed_outcomes(c["mask"], c["good"], c["toxic"]) for c in counts))


def filter_audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Counters of each part (``source``), order of the five filters and step of it.

    ``kept`` are documents left after the step, ``removed`` those that it takes,
    ``redundant`` those that fail its filter but were removed earlier, ``unique_fails``
    those that fail no other filter, ``good_lost`` and ``toxic_lost`` the removed ones with
    a label 1, ``shapley`` the filter's removals summed over all orders.

    Null texts are empty ones and null sources the part ''.  A document is a copy (E) if a
    lesser id has the same text anywhere in the table: rows of one id are no copies of each
    other, and a row without an id neither is a copy nor makes others copies.  Such a row
    has no labels; of several labels of an id, any 1 counts.  Texts of any length are taken
    whole.  Other columns are ignored, whatever their names.  An empty table gives no rows.
    """
    counts = counted_masks(documents, labels)
    # At most 128 masks and labels in a part.
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("counts"))
    return parts.mapInPandas(_reports, REPORT_SCHEMA)
