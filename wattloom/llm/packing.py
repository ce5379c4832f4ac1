"""Packing documents into fixed-size sequences by non-negative least squares.

A document is cut into full windows, which are sequences of their own, and a rest
shorter than a window.  The histogram of rest lengths has at most ``size - 1``
bins whatever the corpus, so the packing is planned on it alone:

1. all shallow combinations of lengths that fill a window (at most ``DEPTH``
   pieces of at most two lengths) are enumerated;
2. non-negative least squares solve how often each is repeated to use up the
   histogram; the counts are rounded down to what is there;
3. what is left is packed greedily, longest first, into windows that come out
   exactly full; rests that fit no such window are laid end to end and cut at
   window borders, and the very last, partly filled window is cut into powers of two.

The plan says, for each rest length, which run of its documents goes where.  Spark
numbers the documents of a length (a prefix sum over partitions, no window over a
hot length) and looks each up in the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.memory import frugal
from wattloom.llm.pretokens import text_encoder
from wattloom.workspace import materialize

DEPTH = 6
ITERATIONS = 400


@dataclass(frozen=True)
class Run:
    """Rests of one length, numbered ``first`` to ``last - 1``, and where they go.

    In a pattern, every ``copies`` rests share a sequence, from ``sequence`` on, the
    first of them at ``offset``.  In the stream (``copies`` 0) they are laid end to
    end from position ``offset`` on.
    """

    length: int
    first: int
    last: int
    sequence: int
    copies: int
    offset: int


@dataclass(frozen=True)
class Plan:
    """Runs by length; the stream begins with ``stream_sequence`` and is ``stream_tokens`` long."""

    runs: list[Run]
    stream_sequence: int
    stream_tokens: int


def combinations(lengths: np.ndarray, size: int, depth: int = DEPTH) -> np.ndarray:
    """Rows ``(a, i, b, j)``: ``i`` pieces of length a and ``j`` of b fill a window.

    ``lengths`` are those there are.  With one length, b and j are 0.
    """
    there = np.zeros(size + 1, bool)
    there[lengths] = True
    found = [
        np.array([[size // i, i, 0, 0]])
        for i in range(2, depth + 1)
        if size % i == 0 and there[size // i]
    ]
    for i in range(1, depth):
        for j in range(1, depth - i + 1):
            a = lengths[i * lengths < size]
            rest = size - i * a
            b = rest // j
            fits = (rest % j == 0) & (a > b) & there[b]
            n = int(fits.sum())
            found.append(np.column_stack([a[fits], np.full(n, i), b[fits], np.full(n, j)]))
    return np.concatenate(found).astype(np.int64) if found else np.zeros((0, 4), np.int64)


def non_negative_least_squares(columns: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 of the combinations, least squares against the histogram.

    Accelerated projected gradient; a matrix column has at most two entries.
    """
    a, i, b, j = columns.T
    bins = len(histogram)

    def used(x: np.ndarray) -> np.ndarray:
        return np.bincount(a, i * x, bins) + np.bincount(b, j * x, bins) * (np.arange(bins) > 0)

    def gradient(residual: np.ndarray) -> np.ndarray:
        return i * residual[a] + j * residual[b]

    probe = np.ones(len(columns))
    for _ in range(30):
        probe = gradient(used(probe))
        step = np.linalg.norm(probe)
        probe /= step
    x = np.zeros(len(columns))
    ahead, pace = x, 1.0
    for _ in range(ITERATIONS):
        moved = np.maximum(0.0, ahead - gradient(used(ahead) - histogram) / (1.05 * step))
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = moved + (pace - 1) / faster * (moved - x)
        x, pace = moved, faster
    return x


def _greedy(left: np.ndarray, size: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Windows that come out full, longest rest first; ``left`` keeps what fits none."""
    patterns = []
    lengths = [int(v) for v in np.nonzero(left)[0][::-1]]
    for at, longest in enumerate(lengths):
        while left[longest]:
            gap, pieces = size, []
            for length in lengths[at:]:
                if copies := min(int(left[length]), gap // length):
                    pieces.append((length, copies))
                    gap -= copies * length
                if not gap:
                    break
            if gap:
                break
            times = min(int(left[length]) // copies for length, copies in pieces)
            for length, copies in pieces:
                left[length] -= times * copies
            patterns.append((pieces, times))
    return patterns


def plan_packing(histogram: dict[int, int], size: int, first_sequence: int = 0) -> Plan:
    """Place all rests; ``histogram`` counts those of each length below ``size``."""
    left = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    patterns: list[tuple[list[tuple[int, int]], int]] = []
    columns = combinations(np.nonzero(left)[0], size)
    if len(columns):
        wanted = non_negative_least_squares(columns, left.astype(float))
        for at in np.argsort(-wanted, kind="stable"):
            a, i, b, j = (int(v) for v in columns[at])
            times = min(int(wanted[at] + 1e-6), int(left[a]) // i)
            times = min(times, int(left[b]) // j) if j else times
            if times:
                left[a] -= i * times
                left[b] -= j * times
                patterns.append(([(a, i), (b, j)] if j else [(a, i)], times))
    patterns += _greedy(left, size)

    runs, taken, sequence = [], dict.fromkeys(histogram, 0), first_sequence

    def run(length: int, rests: int, copies: int, offset: int) -> None:
        first = taken[length]
        taken[length] = first + rests
        runs.append(Run(length, first, first + rests, sequence, copies, offset))

    for pieces, times in patterns:
        offset = 0
        for length, copies in pieces:
            run(length, copies * times, copies, offset)
            offset += copies * length
        sequence += times
    position = 0
    for length in np.nonzero(left)[0][::-1]:
        n = int(left[length])
        run(int(length), n, 0, position)
        position += n * int(length)
    return Plan(runs, sequence, position)


def stream_pieces(position: int, length: int, plan: Plan, size: int) -> Iterator[tuple[int, int, int]]:
    """``(length, sequence, offset)`` of the pieces of a rest laid into the stream.

    The stream is cut into windows; its last ``tokens % size`` positions are cut into
    powers of two, largest first.
    """
    full = plan.stream_tokens // size
    while length:
        number, start = position // size, position // size * size
        width = size
        if number == full:
            tail = plan.stream_tokens - start
            while True:
                width = 1 << (tail.bit_length() - 1)
                if position < start + width:
                    break
                start, tail, number = start + width, tail - width, number + 1
        take = min(length, start + width - position)
        yield take, plan.stream_sequence + number, position - start
        position, length = position + take, length - take


_TOKENIZED = (
    "part int, row long, doc_id {kind}, n long, windows long, rest int, rest_rank long, ids binary"
)


def _tokenized(
    documents: DataFrame, tokenizer: str, end_id: int, size: int, cache: int | None
) -> DataFrame:
    """Ids of each document (16-bit where they fit, compressed) and its place among its part."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(tokenizer, cache)
        squeeze = zstandard.ZstdCompressor(level=1).compress
        part, row, windows = TaskContext.get().partitionId(), 0, 0
        ranks: dict[int, int] = {}
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("row", "n", "windows", "rest", "rank", "ids")}
            for value in batch["text"]:
                ids = np.frombuffer(encoder.ids(value.as_py()), "<u4")
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                narrow = ids.astype("<u2") if ids.max() < 1 << 16 else ids
                rest = len(ids) % size
                rank = ranks.get(rest, 0)
                ranks[rest] = rank + 1
                found = (row, len(ids), windows, rest, rank, squeeze(narrow.tobytes()))
                for values, v in zip(out.values(), found):
                    values.append(v)
                row += 1
                windows += len(ids) // size
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            cells = {c: pa.array(v, kind) for (c, v), kind in zip(out.items(), kinds)}
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(batch), pa.int32()),
                    cells["row"],
                    batch["doc_id"],
                    *(cells[c] for c in ("n", "windows", "rest", "rank", "ids")),
                ],
                ["part", "row", "doc_id", "n", "windows", "rest", "rest_rank", "ids"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.mapInArrow(run, _TOKENIZED.format(kind=kind))


def _expand(packed: bytes, n: int) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(packed, max_output_size=4 * n)
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")


def pack_documents(
    documents: DataFrame,
    tokenizer: str,
    size: int = 2048,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
    cache: int | None = None,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``start`` counts the ids of the document before the piece, ``offset`` the ids of
    the sequence before it; ``ids_crc32`` is over the ids as little-endian unsigned
    32-bit integers, which ``with_ids`` adds as the column ``ids``.  ``cache`` is how many
    pre-tokens a generation of a worker's cache holds.  Sequences are full,
    but for the last few, whose lengths are powers of two.

    A null or empty text is the end id alone.  A null id stays null; repeated rows are
    packed each; other columns are ignored, whatever their names; an empty table gives
    no pieces.
    """
    spark = documents.sparkSession
    plain = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    tokens = materialize(_tokenized(plain, tokenizer, end_id, size, cache), "tokens")
    kind = plain.schema["doc_id"].dataType.simpleString()

    # At most ``size`` rows: the histogram of rest lengths.
    counted = tokens.groupBy("rest").agg(F.count("*").alias("n"), F.sum(F.expr(f"n div {size}")).alias("w"))
    rows = counted.collect()
    windows = sum(r["w"] for r in rows)
    plan = plan_packing({r["rest"]: r["n"] for r in rows if r["rest"]}, size, windows)
    shared = spark.sparkContext.broadcast(Plan([], plan.stream_sequence, plan.stream_tokens))
    # A few runs per length, so at most some ten thousand short rows.
    runs = spark.createDataFrame(
        [(r.length, r.first, r.last, r.sequence, r.copies, r.offset) for r in plan.runs],
        "rest int, first long, last long, sequence long, copies long, at long",
    )

    # Where each part's windows and rests of a length begin: one row per part, or per part and length.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    window_starts = (
        tokens.groupBy("part")
        .agg(F.sum(F.expr(f"n div {size}")).alias("w"))
        .select("part", F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("window_start"))
    )
    same = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    rest_starts = (
        tokens.groupBy("part", "rest")
        .agg(F.count("*").alias("c"))
        .select("part", "rest", F.coalesce(F.sum("c").over(same), F.lit(0)).alias("rest_start"))
    )
    placed = (
        tokens.select("part", "row", "windows", "rest", "rest_rank")
        .join(rest_starts, ["part", "rest"])
        .join(window_starts, "part")
        .withColumn("rank", F.col("rest_start") + F.col("rest_rank"))
        .alias("d")
        .join(
            F.broadcast(runs).alias("r"),
            F.expr("d.rest = r.rest AND d.rank >= r.first AND d.rank < r.last"),
            "left",
        )
        .select(
            "d.part",
            "d.row",
            (F.col("d.window_start") + F.col("d.windows")).alias("first_window"),
            "r.copies",
            F.expr(
                "CASE WHEN r.copies > 0 THEN r.sequence + (d.rank - r.first) div r.copies END"
            ).alias("sequence"),
            F.expr(
                "CASE WHEN r.copies > 0 THEN r.at + ((d.rank - r.first) % r.copies) * d.rest "
                "ELSE r.at + (d.rank - r.first) * d.rest END"
            ).alias("at"),
        )
    )
    joined = tokens.select("part", "row", "doc_id", "n", "ids").join(placed, ["part", "row"])
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def pieces_of(row: dict) -> Iterator[tuple[int, int, int]]:
        full, rest = divmod(row["n"], size)
        for i in range(full):
            yield size, row["first_window"] + i, 0
        if rest and row["copies"]:
            yield rest, row["sequence"], row["at"]
        elif rest:
            yield from stream_pieces(row["at"], rest, shared.value, size)

    @frugal
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 6 + [pa.binary()]
        for batch in batches:
            taken, cells = [], []
            places = batch.drop_columns(["doc_id", "ids"]).to_pylist()
            for number, (row, packed) in enumerate(zip(places, batch["ids"])):
                ids, start = _expand(packed.as_py(), row["n"]), 0
                for length, sequence, offset in pieces_of(row):
                    raw = ids[start : start + length].tobytes()
                    taken.append(number)
                    cells.append(
                        (start, length, zlib.crc32(raw), row["n"], sequence, offset,
                         raw if with_ids else None)
                    )
                    start += length
            columns = [pa.array(v, k) for v, k in zip(zip(*cells), kinds)] if cells else [
                pa.array([], k) for k in kinds
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(taken, pa.int64())), *columns], [*names, "ids"]
            )

    schema = f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names[1:]) + ", ids binary"
    pieces = joined.mapInArrow(cut, schema)
    return pieces if with_ids else pieces.drop("ids")
