"""Near-duplicate documents by an exact n-gram Jaccard join with adaptive prefixes.

A document is the set of its distinct word shingles.  Two sets of Jaccard similarity
``t`` or more that are ordered by one global order, rare shingles first, share a
shingle within the first ``n - ceil(t * n) + 1`` of each, and ``l`` shingles within
prefixes ``l - 1`` longer; prefixes of different ``l`` share the smaller of the two.

1. Document frequencies: each part of the documents sends its shingle hashes and
   counts, packed by hash range, and gets back those that occur in more documents.
   A shingle of one document can be in no intersection, so a document with too few
   others can link with nothing, and drops out.
2. Each document picks its own ``l``: it lengthens its prefix as long as the expected
   cost of reading longer lists is less than what it saves in verifications.
3. Documents that share a shingle of their shortest prefixes meet in one tile: a small
   cluster of such documents, or two blocks of a large one (``tiles``), whose documents
   go there only if they share a shingle with the other block.  In a tile, pairs of
   fitting sizes with enough shared prefix shingles are verified on the whole sets,
   and it returns one row per document: the least document it reaches by links there,
   and its number of links.
4. The links' connected components are the classes.

Documents of equal sets are one representative throughout, and join it at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.components import components
from wattloom.llm.memory import frugal, give_back
from wattloom.llm.tiles import tiles
from wattloom.llm.words import (
    BYTES_AT_ONCE,
    hash_texts,
    mixed,
    pack_ascending,
    rolling_hashes,
    unpack_ascending,
)
from wattloom.workspace import materialize

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 80
# A part is closed when it has so many words; a hash range is made for so many words.
PART_WORDS = 1_000_000
RANGE_WORDS = 4_000_000
LEAST_RANGES = 64
# Documents in a block of a large cluster, and of small tiles packed into one task.
BLOCK = 256
# Longest lengthening of a prefix, and the cost of a verification in list entries read.
LONGEST = 16
VERIFY_COST = 4.0

_BASE = 0x2545F4914F6CDD1D
_COLUMNS_AT_ONCE = 8192


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])]


def shingle_sets(
    texts: Iterable[bytes], size: int = SHINGLE_WORDS
) -> Iterator[tuple[int, np.ndarray]]:
    """Number of words of each text, and ascending hashes of its distinct shingles.

    Fewer words than ``size`` are one shingle of their own.  Texts are hashed some at a
    time, as one run of words; a shingle's hash does not depend on its place there.
    """
    held: list[bytes] = []
    count = 0
    for text in texts:
        held.append(text)
        count += len(text)
        if count >= BYTES_AT_ONCE:
            yield from _sets_of(held, size)
            held, count = [], 0
    if held:
        yield from _sets_of(held, size)


def _sets_of(texts: list[bytes], size: int) -> Iterator[tuple[int, np.ndarray]]:
    hashes, counts = hash_texts(texts)
    rolled = rolling_hashes(hashes, size, _BASE)
    start = 0
    for n in counts.tolist():
        end = start + n
        if n >= size:
            yield n, _distinct(rolled[start : end - size + 1])
        elif n:
            yield n, mixed(rolling_hashes(hashes[start:end], n, _BASE) + np.uint64(n))
        else:
            yield n, np.zeros(0, np.uint64)
        start = end


def _least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` shares with any partner at least."""
    return -(-percent * n // 100)


def _parts(documents: DataFrame, size: int) -> DataFrame:
    """Each document with its part, reference, counts, signature and lower-cased text."""
    schema = pa.schema(
        [
            ("part", pa.int64()),
            ("ref", pa.int64()),
            ("n_words", pa.int64()),
            ("n_shingles", pa.int64()),
            ("signature", pa.binary()),
            ("packed", pa.binary()),
        ]
    )

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        task = TaskContext.get().partitionId()
        part, ref, words = task << 32, task << 33, 0
        for batch in batches:
            out = []
            # Lower-casing bytes changes A-Z only.
            texts = [(text.as_py() or b"").lower() for text in batch["text"]]
            for text, (n, shingles) in zip(texts, shingle_sets(texts, size)):
                out.append(
                    {
                        "part": part,
                        "ref": ref,
                        "n_words": n,
                        "n_shingles": len(shingles),
                        "signature": hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
                        if n
                        else None,
                        "packed": squeeze(text),
                    }
                )
                ref, words = ref + 1, words + n
                if words >= PART_WORDS:
                    part, words = part + 1, 0
            found = pa.RecordBatch.from_pylist(out, schema)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *found.columns], ["doc_id", *found.schema.names]
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.mapInArrow(
        run,
        f"doc_id {kind}, part long, ref long, n_words long, n_shingles long, "
        "signature binary, packed binary",
    )


def _placed(shingles: np.ndarray, ranges: int) -> np.ndarray:
    """Range (upper half) and key (lower half) of shingle hashes."""
    upper = ((shingles >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    return (upper << np.uint64(32)) | (shingles & np.uint64(0xFFFFFFFF))


def _squeezed(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(counts.astype("<u4").tobytes())


def _expanded(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u4").astype(np.int64)


def _count_rows(size: int, ranges: int):
    schema = pa.schema(
        [("range", pa.int32()), ("part", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]
    )

    def rows_of(part: int, sets: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(_placed(np.concatenate(sets), ranges), return_counts=True)
        cuts = np.searchsorted(keys, np.arange(ranges + 1, dtype=np.uint64) << np.uint64(32))
        out = []
        for r in np.nonzero(np.diff(cuts))[0]:
            own = slice(cuts[r], cuts[r + 1])
            out.append(
                {
                    "range": int(r),
                    "part": part,
                    "keys": pack_ascending(keys[own].astype(np.uint32)),
                    "counts": _squeezed(counts[own]),
                }
            )
        return pa.RecordBatch.from_pylist(out, schema)

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        part, sets, held = None, [], 0
        for batch in batches:
            texts = (expand(packed.as_py()) for packed in batch["packed"])
            for key, (_, shingles) in zip(batch["part"].to_pylist(), shingle_sets(texts, size)):
                if sets and (key != part or held >= PART_WORDS):
                    yield rows_of(part, sets)
                    sets, held = [], 0
                part = key
                sets.append(shingles)
                held += len(shingles)
        if sets:
            yield rows_of(part, sets)

    return run


def _frequent(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one hash range: frequencies over one, for each part that has the shingle."""
    own = [unpack_ascending(v, "u4") for v in rows["keys"]]
    keys = np.concatenate(own)
    counts = np.concatenate([_expanded(v) for v in rows["counts"]])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0]
    keys, counts = keys[first], np.minimum(np.add.reduceat(counts, first), 0xFFFFFFFF)
    out = []
    for part, mine in zip(rows["part"], own):
        df = counts[np.searchsorted(keys, mine)]
        shared = df > 1
        if shared.any():
            out.append((part, pack_ascending(mine[shared]), _squeezed(df[shared])))
    del own, keys, counts
    give_back()
    found = pd.DataFrame(out, columns=["part", "keys", "counts"])
    found["range"] = rows["range"].iloc[0]
    found["copies"] = None
    return found


def prefix_order(shingles: np.ndarray, frequency: np.ndarray) -> np.ndarray:
    """Positions of a set's shingles in the global order: by frequency, then by hash."""
    return np.lexsort((shingles, frequency))


def adaptive_length(frequency: np.ndarray, shortest: int, least: int) -> int:
    """How many shared prefix shingles a document asks for.

    ``frequency`` is in the global order, 0 for shingles of no other document.  A prefix
    for ``l`` reads the lists of its shingles; at most their sum divided by ``l``
    documents can share ``l`` of them and be verified.
    """
    wanted = np.arange(1, max(1, min(LONGEST, least, len(frequency) - shortest + 1)) + 1)
    lists = np.cumsum(frequency)[shortest + wanted - 2]
    return int(wanted[np.argmin(lists + VERIFY_COST * lists / wanted)])


def _prefixes(size: int, percent: int, ranges: int):
    """Per part: documents that can have links, with prefixes and shared shingles."""

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        expand = zstandard.ZstdDecompressor().decompress
        keys, counts, copies = [], [], set()
        for r, own, df, refs in zip(*(known[c].to_pylist() for c in ("range", "keys", "counts", "copies"))):
            if refs is not None:
                copies.update(refs)
                continue
            keys.append(unpack_ascending(own, "u4").astype(np.uint64) | np.uint64(r << 32))
            counts.append(_expanded(df))
        places = np.concatenate([np.zeros(0, np.uint64), *keys])
        totals = np.concatenate([np.zeros(0, np.int64), *counts])
        order = np.argsort(places)
        places, totals = places[order], totals[order]
        out = []
        rows = [
            row
            for row in zip(texts["ref"].to_pylist(), texts["packed"])
            if row[0] not in copies and len(places)
        ]
        sets = shingle_sets((expand(packed.as_py()) for _, packed in rows), size)
        for (ref, _), (_, shingles) in zip(rows, sets):
            own = _placed(shingles, ranges)
            at = np.minimum(np.searchsorted(places, own), len(places) - 1)
            frequency = np.where(places[at] == own, totals[at], 0)
            n, least = len(shingles), _least_overlap(len(shingles), percent)
            if np.count_nonzero(frequency) < least:
                continue
            order = prefix_order(shingles, frequency)
            ranked, ordered = frequency[order], shingles[order]
            shortest = n - least + 1
            length = adaptive_length(ranked, shortest, least)
            reach = shortest + length - 1
            first = ordered[:shortest][ranked[:shortest] > 0]
            if len(first):
                out.append(
                    {
                        "ref": ref,
                        "n": n,
                        "needs": length,
                        "first": first.view(np.int64).tolist(),
                        "prefix": ordered[:reach][ranked[:reach] > 0].tobytes(),
                        "shared": shingles[frequency > 0].tobytes(),
                    }
                )
        give_back()
        return pa.Table.from_pylist(
            out,
            pa.schema(
                [
                    ("ref", pa.int64()),
                    ("n", pa.int64()),
                    ("needs", pa.int32()),
                    ("first", pa.list_(pa.int64())),
                    ("prefix", pa.binary()),
                    ("shared", pa.binary()),
                ]
            ),
        )

    return run


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, as matrix products."""
    sets = left + right
    sizes = np.array([len(s) for s in sets])
    vocabulary, column, seen = np.unique(
        np.concatenate(sets), return_inverse=True, return_counts=True
    )
    row = np.repeat(np.arange(len(sets)), sizes)
    keep = seen[column] > 1
    row, column = row[keep], column[keep]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    found = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(vocabulary), _COLUMNS_AT_ONCE):
        lo, hi = np.searchsorted(column, (start, start + _COLUMNS_AT_ONCE))
        if lo < hi:
            there = np.zeros((len(sets), _COLUMNS_AT_ONCE), np.float32)
            there[row[lo:hi], column[lo:hi] - start] = 1
            used = np.unique(column[lo:hi]) - start
            there = there[:, used]
            found += there[: len(left)] @ there[len(left) :].T
    return found


def links_of(rows: list[dict], other: list[dict] | None, percent: int) -> np.ndarray:
    """Which pairs of documents link; ``other`` None: pairs of ``rows`` with each other.

    Pairs must fit in size and share as many prefix shingles as the less demanding
    document asks for; those that do are verified on all their shared shingles.
    """
    own = other if other is not None else rows
    n, m = (np.array([r["n"] for r in x], np.int64) for x in (rows, own))
    needs = np.minimum.outer([r["needs"] for r in rows], [r["needs"] for r in own])
    arrays = lambda x, c: [np.frombuffer(r[c], np.uint64) for r in x]
    fits = 100 * np.minimum.outer(n, m) >= percent * np.maximum.outer(n, m)
    wanted = fits & (_common(arrays(rows, "prefix"), arrays(own, "prefix")) >= needs)
    if other is None:
        np.fill_diagonal(wanted, False)
    links = np.zeros_like(wanted)
    some, others = wanted.any(axis=1), wanted.any(axis=0)
    if some.any():
        a, b = np.nonzero(some)[0], np.nonzero(others)[0]
        both = _common(
            [np.frombuffer(rows[i]["shared"], np.uint64) for i in a],
            [np.frombuffer(own[i]["shared"], np.uint64) for i in b],
        )
        enough = 100 * both >= percent * (np.add.outer(n[a], m[b]) - both)
        links[np.ix_(a, b)] = enough & wanted[np.ix_(a, b)]
    return links


def _reached(links: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """The least reference that each node of a square link matrix reaches."""
    least = refs.copy()
    while True:
        near = np.where(links, least[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
        moved = np.minimum(least, near)
        if (moved == least).all():
            return least
        least = moved


def _tile_links(percent: int):
    def tile(rows: list[dict]) -> Iterator[tuple[int, int, int]]:
        left = [r for r in rows if r["side"] == 0]
        right = [r for r in rows if r["side"] == 1]
        if rows[0]["i"] == rows[0]["j"]:
            links = links_of(left, None, percent)
        else:
            links = np.zeros((len(left), len(right)), bool)
            if left and right:
                links = links_of(left, right, percent)
            square = np.zeros((len(rows), len(rows)), bool)
            square[: len(left), len(left) :] = links
            square[len(left) :, : len(left)] = links.T
            links = square
        everyone = left + right
        refs = np.array([r["ref"] for r in everyone], np.int64)
        weights = np.array([r["copies"] for r in everyone], np.int64)
        counts = links.astype(np.int64) @ weights
        yield from zip(refs.tolist(), _reached(links, refs).tolist(), counts.tolist())

    def run(table: pa.Table) -> pa.Table:
        by_tile: dict[tuple[int, int], list[dict]] = {}
        for row in table.to_pylist():
            by_tile.setdefault((row["i"], row["j"]), []).append(row)
        found = [x for rows in by_tile.values() for x in tile(rows)]
        cells = list(zip(*found)) or [[], [], []]
        give_back()
        return pa.table([pa.array(c, pa.int64()) for c in cells], ["u", "v", "links"])

    return run


def near_duplicates(
    documents: DataFrame,
    size: int = SHINGLE_WORDS,
    percent: int = THRESHOLD_PERCENT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` for each row of ``documents``.

    Words are runs of characters other than ASCII white space, A-Z lower-cased; a set
    holds the distinct shingles of ``size`` words, or the whole sequence if there are
    fewer.  Two documents link if ``100 * intersection >= percent * union``;
    ``component_id`` is the least id reachable by links and ``n_links`` the number of
    other rows that a row links with.

    A null or empty text, or one of white space, has no shingles and links with nothing.
    Repeated rows are documents each and link with each other; null ids count as no id:
    a component's id is the least there is, null without one.  Other columns are ignored,
    whatever their names; an empty table gives an empty result.
    """
    plain = documents.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text")
    )
    texts = materialize(_parts(plain, size), "texts")
    total = texts.agg(F.sum("n_words")).first()[0] or 0
    ranges = max(LEAST_RANGES, total // RANGE_WORDS)
    slim = texts.select("doc_id", "part", "ref", "n_shingles", "signature")
    classes = materialize(
        slim.where("signature IS NOT NULL")
        .groupBy("signature")
        .agg(F.min("ref").alias("rep"), F.count("*").alias("copies"), F.min("doc_id").alias("least_id")),
        "classes",
    )
    # References of a part's documents that repeat an earlier set: at most a part's rows.
    repeats = (
        slim.join(classes.where("copies > 1"), "signature")
        .where("ref <> rep")
        .groupBy("part")
        .agg(F.collect_list("ref").alias("copies"))
        .selectExpr(
            "part", "CAST(null AS binary) AS keys", "CAST(null AS binary) AS counts",
            "CAST(null AS int) AS range", "copies",
        )
    )
    bodies = texts.where(F.col("n_words") >= size).select("part", "ref", "packed")
    frequent = (
        bodies.mapInArrow(_count_rows(size, ranges), "range int, part long, keys binary, counts binary")
        .groupBy("range")
        .applyInPandas(
            _frequent, "part long, keys binary, counts binary, range int, copies array<long>"
        )
    )
    candidates = materialize(
        bodies.groupBy("part")
        .cogroup(frequent.union(repeats).groupBy("part"))
        .applyInArrow(
            _prefixes(size, percent, ranges),
            "ref long, n long, needs int, first array<long>, prefix binary, shared binary",
        ),
        "candidates",
    )

    postings = candidates.select("ref", F.explode("first").alias("token"))
    tokens = (
        postings.groupBy("token")
        .agg(F.min("ref").alias("least"), F.count("*").alias("n"))
        .where("n > 1")
        .select("token", "least")
    )
    clusters = components(
        postings.join(tokens, "token").select(F.col("ref").alias("u"), F.col("least").alias("v"))
    )
    clusters = materialize(clusters.select(F.col("node").alias("ref"), F.col("component").alias("cluster")), "clusters")
    members = (
        tiles(clusters, candidates, BLOCK)
        .join(candidates.drop("first"), "ref")
        .join(classes.select(F.col("rep").alias("ref"), "copies"), "ref")
    )
    reached = materialize(
        members.groupBy("pack").applyInArrow(_tile_links(percent), "u long, v long, links long"),
        "reached",
    )
    joined = components(reached.select("u", "v"))

    counts = reached.groupBy("u").agg(F.sum("links").alias("links"))
    ids = (
        classes.join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .join(counts.withColumnRenamed("u", "rep"), "rep", "left")
        .select(
            "signature",
            F.coalesce("component", "rep").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            "least_id",
        )
    )
    ids = materialize(ids, "ids")
    least = ids.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = ids.join(least, "component").select("signature", "component_id", "n_links")
    return slim.join(named, "signature", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("signature").isNull(), F.col("doc_id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
