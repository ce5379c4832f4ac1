"""Exact top-k inner-product search by blocks.

Queries and candidates are packed into rows of many vectors, in the narrowest integers
that hold them.  Rows of queries form groups, rows of candidates as well, and every group
of queries meets every group of candidates in a block: a row is sent once to each block of
its group, not once to each row it meets.  A task holds the queries of a block, takes its
candidates as they come, and gets all scores of a tile of queries and a shard of candidates
by one matrix product.  It keeps each query's k best so far, so only scores that reach the
least of them are looked at.  The lists of a tile are then merged as a tree, ``FAN_IN`` at
a time, so no task holds more than ``FAN_IN`` lists of one tile.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.columns import if_small
from wattloom.llm.memory import frugal
from wattloom.workspace import materialize

TILE_VECTORS = 1024
SHARD_VECTORS = 4096
FAN_IN = 16
# Queries that a task holds, and their bytes with their lists.
GROUP_QUERIES = 32_768
GROUP_BYTES = 32 << 20
# Scores of a block: at most about so many, and no fewer than that to occupy idle cores.
BLOCK_SCORES, LEAST_SCORES = 1 << 32, 1 << 26

_MOST_PARTITIONS = 10_000
_NO_SCORE = np.iinfo(np.int64).min


def quantized(vector: Column, scale: int = 64) -> Column:
    """``floor(scale * x)`` of every component as long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("long"))


def is_usable(vector: Column) -> Column:
    """True for vectors that are there and whose components are all finite numbers."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(math.inf))
    )
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def _padded(pieces: list[np.ndarray]) -> np.ndarray:
    """Matrices below each other; shorter vectors are filled up with zeros."""
    width = max(m.shape[1] for m in pieces)
    return np.concatenate([np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in pieces])


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    inside = np.arange(lengths.max(initial=0)) < lengths[:, None]
    own = np.zeros(inside.shape, np.int64)
    own[inside] = vectors.flatten().to_numpy(zero_copy_only=False)
    return own


def _narrow(own: np.ndarray) -> np.ndarray:
    low, high = int(own.min(initial=0)), int(own.max(initial=0))
    fits = lambda kind: np.iinfo(kind).min <= low and high <= np.iinfo(kind).max
    return own.astype(next(kind for kind in (np.int8, np.int16, np.int32, np.int64) if fits(kind)))


def _collected(size: int, pieces: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Consecutive pieces of ids and vectors as one, of at most ``size`` vectors or a single piece."""
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    for piece in pieces:
        if kept and sum(len(ids) for ids, _ in kept) + len(piece[0]) > size:
            yield np.concatenate([ids for ids, _ in kept]), _padded([own for _, own in kept])
            kept = []
        kept.append(piece)
    if kept:
        yield np.concatenate([ids for ids, _ in kept]), _padded([own for _, own in kept])


def _by_id(ids: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(ids, kind="stable")
    return ids[order], own[order]


def _pack(size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pieces that fill up rows of ``size`` vectors."""
        room = size
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                part = batch.slice(start, room)
                yield part["id"].to_numpy(zero_copy_only=False), _matrix(part["vector"])
                start += part.num_rows
                room = room - part.num_rows or size

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of at most ``size`` vectors, each in the order of their ids."""
        for ids, own in _collected(size, cut(batches)):
            ids, own = _by_id(ids, _narrow(own))
            row = {"ids": ids.tobytes(), "data": own.tobytes(), "n": len(ids), "width": own.shape[1]}
            yield pa.RecordBatch.from_pylist([row | {"bytes": own.itemsize}], _PACKED)

    return pack


_PACKED = pa.schema(
    [("ids", pa.binary()), ("data", pa.binary()), ("n", pa.int64()), ("width", pa.int64()), ("bytes", pa.int32())]
)


def _rows(vectors: DataFrame, size: int, label: str) -> DataFrame:
    """Packed vectors, each row with a stored number ``at``."""
    packed = vectors.mapInArrow(frugal(_pack(size)), "ids binary, data binary, n long, width long, bytes int")
    return materialize(packed.withColumn("at", F.monotonically_increasing_id()), label)


def _grouped(rows: DataFrame, vectors: int, groups: int) -> DataFrame:
    """``rows`` with the number of their group; groups hold about as many vectors each."""
    # One short row per packed row.
    before = F.sum("n").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    group = F.floor(F.coalesce(before, F.lit(0)) / F.lit(max(1, -(-vectors // groups)))).cast("long")
    numbers = materialize(rows.select("at", group.alias("group")), "groups")
    return rows.join(if_small(numbers), "at")


def _largest(values: np.ndarray) -> int:
    return max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0))))


def _length(values: np.ndarray) -> float:
    """Length of the longest vector."""
    own = values.astype(np.float64)
    return math.sqrt(np.einsum("ij,ij->i", own, own).max(initial=0))


def _products(queries: np.ndarray, vectors: np.ndarray, length: float) -> np.ndarray:
    """All inner products, exact; ``length`` is at least that of any query times that of any vector.

    No sum of some of the products of components is more than the vectors' lengths
    multiplied, so whole numbers below the limits of a float stay exact in any order.
    """
    for kind, limit in ((np.float32, 1 << 24), (np.float64, 1 << 53)):
        if length * (1 + 1e-9) < limit:
            return queries.astype(kind) @ vectors.astype(kind).T
    if _largest(queries) * _largest(vectors) * max(1, queries.shape[1]) >= (1 << 63) - 1:
        raise OverflowError("scores of these vectors do not fit 64-bit integers")
    return queries.astype(np.int64) @ vectors.astype(np.int64).T


class _Best:
    """The k best candidates so far of a tile of queries; places without one hold no score."""

    def __init__(self, ids: np.ndarray, own: np.ndarray, k: int):
        self.query_ids, self.own, self.k, self.length = ids, own, k, _length(own)
        self.ids = np.zeros((len(ids), k), np.int64)
        self.scores = np.full((len(ids), k), _NO_SCORE, np.int64)

    def meet(self, ids: np.ndarray, vectors: np.ndarray, length: float) -> None:
        """Take in a shard, whose ``ids`` ascend."""
        queries = self.own
        if queries.shape[1] != vectors.shape[1]:
            width = max(queries.shape[1], vectors.shape[1])
            queries, vectors = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (queries, vectors))
        scores = _products(queries, vectors, self.length * length)
        whole = scores.dtype == np.int64
        least = _NO_SCORE + 1 if whole else np.finfo(scores.dtype).min
        first, last = np.searchsorted(ids, self.query_ids), np.searchsorted(ids, self.query_ids, "right")
        for row in np.nonzero(last > first)[0]:
            scores[row, first[row] : last[row]] = _NO_SCORE if whole else -np.inf
        worst = self.scores[:, -1]
        floor = np.where(worst == _NO_SCORE, least, worst.astype(scores.dtype))[:, None]
        reach = scores >= floor
        if np.count_nonzero(reach) > 4 * self.k * len(reach):
            reach = self._best_of_shard(scores, floor)
        at = np.flatnonzero(reach)
        if len(at):
            rows, columns = np.divmod(at, len(ids))
            self._add(rows, ids[columns], scores.ravel()[at].astype(np.int64))

    def _best_of_shard(self, scores: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Which scores are among each query's k best here, ties by smaller id, and reach the floor."""
        n = scores.shape[1]
        if n > self.k:
            floor = np.maximum(floor, np.partition(scores, n - self.k, axis=1)[:, n - self.k, None])
        over, ties = scores > floor, scores == floor
        room = self.k - np.count_nonzero(over, axis=1)
        return over | ties & (np.cumsum(ties, axis=1, dtype=np.int32) <= room[:, None])

    def _add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Take in more candidates of the given rows."""
        own = np.unique(rows)
        rows = np.concatenate([np.repeat(own, self.k), rows])
        ids = np.concatenate([self.ids[own].ravel(), ids])
        scores = np.concatenate([self.scores[own].ravel(), scores])
        order = np.lexsort((ids, -np.maximum(scores, _NO_SCORE + 1), rows))
        rows = rows[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = place < self.k
        rows, place, order = rows[kept], place[kept], order[kept]
        self.ids[rows, place], self.scores[rows, place] = ids[order], scores[order]


def _ordered(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row, best first, ties by smaller id."""
    order = np.lexsort((ids, -np.maximum(scores, _NO_SCORE + 1)), axis=1)[:, :k]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)


_LISTS = "tile long, node long, query_ids binary, ids binary, scores binary"


def _search(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch[c][i] for c in batch.schema.names}
                n, width, size = (row[c].as_py() for c in ("n", "width", "bytes"))
                ids = np.frombuffer(row["ids"].as_buffer(), np.int64)
                own = np.frombuffer(row["data"].as_buffer(), f"i{size}").reshape(n, width)
                yield tuple(row[c].as_py() for c in ("tiles", "shards", "side")), ids, own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lists of each block: its queries come first, then its candidates."""
        for (tiles, shards), block in groupby(vectors(batches), lambda x: x[0][:2]):
            best: list[_Best] = []
            for side, own in groupby(block, lambda x: x[0][2]):
                pieces = (x[1:] for x in own)
                if side == 0:
                    best = [_Best(*tile, k) for tile in _collected(TILE_VECTORS, pieces)]
                elif best:
                    for shard in _collected(SHARD_VECTORS, pieces):
                        ids, candidates = _by_id(*shard)
                        length = _length(candidates)
                        for tile in best:
                            tile.meet(ids, candidates, length)
            for i, tile in enumerate(best):
                row = {
                    "tile": (tiles << 32) + i,
                    "node": shards // FAN_IN,
                    "query_ids": tile.query_ids.tobytes(),
                    "ids": tile.ids.tobytes(),
                    "scores": tile.scores.tobytes(),
                }
                yield pa.RecordBatch.from_pylist([row])

    return run


def _merge(k: int):
    def run(lists: pd.DataFrame) -> pd.DataFrame:
        rows = len(lists["query_ids"].iloc[0]) // 8
        ids, scores = (
            np.concatenate([np.frombuffer(x, np.int64).reshape(rows, -1) for x in lists[c]], axis=1)
            for c in ("ids", "scores")
        )
        best, kept = _ordered(ids, scores, k)
        merged = lists.iloc[:1].copy()
        merged["node"] //= FAN_IN
        merged["ids"], merged["scores"] = [best.tobytes()], [kept.tobytes()]
        return merged

    return run


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            query_ids = np.frombuffer(row["query_ids"], np.int64)
            ids, scores = (
                np.frombuffer(row[c], np.int64).reshape(len(query_ids), -1)
                for c in ("ids", "scores")
            )
            at, rank = np.nonzero(scores != _NO_SCORE)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(query_ids[at]),
                    pa.array((rank + 1).astype(np.int32)),
                    pa.array(ids[at, rank]),
                    pa.array(scores[at, rank]),
                ],
                ["query_id", "rank", "vec_id", "score"],
            )


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "vector",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` greatest inner products.

    Both tables hold an id and an ``array<bigint>`` per row.  Rows with the query's
    own id are no candidates; ties go to the smaller id; with fewer than ``k``
    candidates all are returned.  Rows with a null id or vector, or a null component,
    take no part; shorter vectors count as filled up with zeros; empty vectors score
    0.  Repeated candidate rows are candidates each, repeated query rows get a list
    each.  Other columns are ignored.  Scores must fit a 64-bit integer, otherwise
    the query fails.  An empty table on either side gives no rows.
    """

    def plain(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vector"))
        return rows.where("id IS NOT NULL AND vector IS NOT NULL").where(
            F.forall("vector", lambda x: x.isNotNull())
        )

    tiles = _rows(plain(queries), TILE_VECTORS, "tiles")
    shards = _rows(plain(candidates), SHARD_VECTORS, "shards")
    wide = F.max(F.col("width") * F.col("bytes"))
    n_queries, query_bytes = (x or 0 for x in tiles.agg(F.sum("n"), wide).first())
    n_vectors, n_shards = shards.agg(F.sum("n"), F.count("*")).first()
    held = min(GROUP_QUERIES, max(TILE_VECTORS, GROUP_BYTES // (query_bytes + 16 * k)))
    tile_groups = max(1, -(-n_queries // held))
    scores = n_queries * (n_vectors or 0)
    cores = tiles.sparkSession.sparkContext.defaultParallelism
    blocks = max(-(-scores // BLOCK_SCORES), min(3 * cores, scores // LEAST_SCORES))
    shard_groups = max(1, min(-(-blocks // tile_groups), n_shards))

    def sent(rows: DataFrame, vectors: int, side: int) -> DataFrame:
        """A copy of each row for every block of its group."""
        own, others = ("tiles", "shards") if side == 0 else ("shards", "tiles")
        groups = {"tiles": tile_groups, "shards": shard_groups}
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups[others] - 1).cast("long")))
        own_rows = _grouped(rows, vectors, groups[own]).withColumnRenamed("group", own)
        copies = own_rows.select("*", every.alias(others), F.lit(side).alias("side"))
        return copies.select("tiles", "shards", "side", "at", *_PACKED.names)

    count = min(tile_groups * shard_groups, _MOST_PARTITIONS)
    both = sent(tiles, n_queries, 0).unionAll(sent(shards, n_vectors or 0, 1))
    number = (F.col("tiles") * shard_groups + F.col("shards")) % count
    dealt = both.repartitionById(count, number.cast("int")).sortWithinPartitions("tiles", "shards", "side", "at")
    lists = dealt.mapInArrow(frugal(_search(k)), _LISTS)
    nodes = shard_groups
    while nodes > 1:
        nodes = -(-nodes // FAN_IN)
        lists = lists.groupBy("tile", "node").applyInPandas(_merge(k), _LISTS)
    return lists.mapInArrow(_unpack, "query_id long, rank int, vec_id long, score long")
