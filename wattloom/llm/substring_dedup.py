"""Removal of word sequences that repeat anywhere in the corpus.

A window is ``window`` consecutive words.  Any window holds a whole reference block
of ``(window + 1) // 2`` words, if blocks lie end to end from a document's first
word.  So if a window occurs twice, a block of either place occurs as a rolling
window at the other:

1. *anchors*: all reference blocks are indexed by hash and probed with every
   rolling window of the block's length; a block met at two places or more is hot;
2. *extension*: only windows around hot places are looked at; those whose full
   hash occurs at two places or more are repeats, and together they make up the
   maximal exact repeats, whose words are removed.

Both steps exchange sorted hashes, not rows: a part of the documents sends each of
its hashes once, with a mark if it has several of them, packed by hash range, and
gets back those that count.  A passage that a third of all documents share costs
each part one entry.  Full hashes have 64 bits besides those that choose the range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.memory import frugal, give_back
from wattloom.llm.words import (
    hash_texts,
    is_among,
    pack_ascending,
    rolling_hashes,
    split_words,
    unpack_ascending,
)
from wattloom.workspace import materialize

WINDOW = 35
# A part is closed when it has so many words; a hash range is made for so many words.
PART_WORDS = 1_000_000
RANGE_WORDS = 4_000_000
LEAST_RANGES = 64

_ANCHOR_BASE = 0x2545F4914F6CDD1D
_FULL_BASE = 0x5851F42D4C957F2D
_RANGE_BASE = 0x14057B7EF767814F

_TEXTS = pa.schema(
    [
        ("part", pa.int64()),
        ("row", pa.int64()),
        ("n_words", pa.int64()),
        ("packed", pa.binary()),
        ("all_sha256", pa.string()),
    ]
)
_HASH_ROWS = "range int, part long, once binary, again binary, blocks binary"


def _parts(documents: DataFrame) -> DataFrame:
    """Each document with its part, its row there, and its compressed words."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        part, row, words = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            out = []
            for text in batch["text"]:
                own = split_words(text.as_py())
                joined = b" ".join(own)
                out.append(
                    {
                        "part": part,
                        "row": row,
                        "n_words": len(own),
                        "packed": squeeze(joined),
                        "all_sha256": hashlib.sha256(joined).hexdigest(),
                    }
                )
                row, words = row + 1, words + len(own)
                if words >= PART_WORDS:
                    part, row, words = part + 1, 0, 0
            found = pa.RecordBatch.from_pylist(out, _TEXTS)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *found.columns], ["doc_id", *found.schema.names]
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.mapInArrow(
        run,
        f"doc_id {kind}, part long, row long, n_words long, packed binary, all_sha256 string",
    )


class _Words:
    """The words of several documents as one array of hashes."""

    def __init__(self, packed: list[bytes]):
        expand = zstandard.ZstdDecompressor().decompress
        self.texts = [expand(p) for p in packed]
        self.hashes, counts = hash_texts(self.texts)
        self.ends = np.cumsum(counts, dtype=np.int64)
        self.starts = self.ends - counts
        self.own_end = np.repeat(self.ends, counts)
        self.own_start = np.repeat(self.starts, counts)

    def rolling(self, length: int, base: int) -> np.ndarray:
        return rolling_hashes(self.hashes, length, base)

    def whole(self, length: int) -> np.ndarray:
        """Which runs of ``length`` words lie within one document."""
        n = max(0, len(self.hashes) - length + 1)
        return np.arange(n) + length <= self.own_end[:n]

    def anchors(self, block: int, ranges: int) -> np.ndarray:
        """Range (upper half) and key (lower half) of every run of a block's length."""
        found = self.rolling(block, _ANCHOR_BASE)
        upper = ((found >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
        return (upper << np.uint64(32)) | (found & np.uint64(0xFFFFFFFF))

    def full(self, window: int, ranges: int) -> tuple[np.ndarray, np.ndarray]:
        """Range and 64-bit hash of every window; the range comes from another hash."""
        other = self.rolling(window, _RANGE_BASE) >> np.uint64(32)
        upper = (other * np.uint64(ranges)) >> np.uint64(32)
        return upper.astype(np.int64), self.rolling(window, _FULL_BASE)


def _once_and_again(ascending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value once, and those there are several of."""
    if not len(ascending):
        return ascending, ascending
    first = np.concatenate([[True], ascending[1:] != ascending[:-1]])
    again = np.concatenate([~first[1:], [False]]) & first
    return ascending[first], ascending[again]


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        rows,
        pa.schema(
            [
                ("range", pa.int32()),
                ("part", pa.int64()),
                ("once", pa.binary()),
                ("again", pa.binary()),
                ("blocks", pa.binary()),
            ]
        ),
    )


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """Rows of one part at a time, as far as they follow each other; a part may come in pieces."""
    held: list[dict] = []
    words = 0
    for batch in batches:
        for row in batch.to_pylist():
            if held and (held[0]["part"] != row["part"] or words >= PART_WORDS):
                yield held[0]["part"], held
                held, words = [], 0
            held.append(row)
            words += row["n_words"]
    if held:
        yield held[0]["part"], held


def _anchor_rows(block: int, ranges: int):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _by_part(batches):
            words = _Words([r["packed"] for r in rows])
            found = words.anchors(block, ranges)
            whole = words.whole(block)
            place = np.arange(len(found)) - words.own_start[: len(found)]
            once, again = _once_and_again(np.sort(found[whole]))
            blocks = np.unique(found[whole & (place % block == 0)])
            edges = np.arange(ranges + 1, dtype=np.uint64) << np.uint64(32)
            cuts = [np.searchsorted(v, edges) for v in (once, again, blocks)]
            out = []
            for r in range(ranges):
                own = [
                    pack_ascending(v[c[r] : c[r + 1]].astype(np.uint32))
                    for v, c in zip((once, again, blocks), cuts)
                ]
                if own[0]:
                    out.append(
                        {"range": r, "part": part, "once": own[0], "again": own[1], "blocks": own[2]}
                    )
            yield _rows(out)

    return run


def _window_rows(window: int, ranges: int):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _by_part(batches):
            words = _Words([r["packed"] for r in rows])
            upper, found = words.full(window, ranges)
            wanted = _candidate_mask(words, rows, len(found))
            upper, found = upper[wanted], found[wanted]
            order = np.lexsort((found, upper))
            upper, found = upper[order], found[order]
            cuts = np.searchsorted(upper, np.arange(ranges + 1))
            out = []
            for r in np.unique(upper):
                once, again = _once_and_again(found[cuts[r] : cuts[r + 1]])
                out.append(
                    {
                        "range": int(r),
                        "part": part,
                        "once": pack_ascending(once),
                        "again": pack_ascending(again),
                        "blocks": b"",
                    }
                )
            yield _rows(out)

    return run


def _repeated(kind: str, with_blocks: bool):
    """Of one hash range: the hashes that occur twice or more, for each part that has them."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        own = [unpack_ascending(v, kind) for v in rows["once"]]
        more = [unpack_ascending(v, kind) for v in rows["again"]]
        _, hot = _once_and_again(np.sort(np.concatenate([*own, *more])))
        if with_blocks:
            blocks = [unpack_ascending(v, kind) for v in rows["blocks"]]
            hot = hot[is_among(hot, np.unique(np.concatenate(blocks)))]
        found = [pack_ascending(v[is_among(v, hot)]) for v in own]
        out = pd.DataFrame({"part": rows["part"], "range": rows["range"], "hashes": found})
        del own, more, hot
        give_back()
        return out[out["hashes"].str.len() > 0]

    return run


def _candidate_mask(words: _Words, rows: list[dict], n: int) -> np.ndarray:
    """Window starts that the rows' stored ranges of candidates name."""
    mask = np.zeros(n + 1, np.int64)
    for start, row in zip(words.starts, rows):
        spans = np.frombuffer(row["candidates"], np.int32).reshape(-1, 2) + start
        np.add.at(mask, spans[:, 0], 1)
        np.add.at(mask, spans[:, 1], -1)
    return np.cumsum(mask[:n]) > 0


def _spans(mask: np.ndarray) -> np.ndarray:
    """Start and end of every run of true values."""
    edges = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.column_stack([np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]]).astype(np.int32)


def _hot_places(window: int, block: int, ranges: int):
    """Documents of a part with windows that hold a hot block, and where those begin."""

    def run(texts: pa.Table, hot: pa.Table) -> pa.Table:
        own = [unpack_ascending(x.as_py(), "u4") for x in hot["hashes"]]
        upper = np.repeat(hot["range"].to_numpy().astype(np.uint64), [len(v) for v in own])
        known = np.sort(
            (upper << np.uint64(32)) | np.concatenate([np.zeros(0, "u4"), *own]).astype(np.uint64)
        )
        words = _Words(texts["packed"].to_pylist())
        hits = is_among(words.anchors(block, ranges), known) & words.whole(block)
        sums = np.concatenate([[0], np.cumsum(hits)])
        whole = words.whole(window)
        n, reach = len(whole), window - block + 1
        wanted = whole & (sums[reach : reach + n] - sums[:n] > 0)
        wanted = np.concatenate([wanted, np.zeros(len(words.hashes) - n, bool)])
        spans = [_spans(wanted[s:e]) for s, e in zip(words.starts, words.ends)]
        taken = [i for i, s in enumerate(spans) if len(s)]
        kept = texts.select(["part", "row", "n_words", "packed"]).take(pa.array(taken, pa.int64()))
        cells = pa.array([spans[i].tobytes() for i in taken], pa.binary())
        del words, hits, wanted, known, own, upper
        give_back()
        return kept.append_column("candidates", cells)

    return run


def _removed(window: int, ranges: int):
    """Removed word ranges and the hash of what is kept, for the suspects of a part."""

    def run(rows: pa.Table, repeated: pa.Table) -> pa.Table:
        suspects = rows.to_pylist()
        words = _Words([r["packed"] for r in suspects])
        upper, found = words.full(window, ranges)
        wanted = _candidate_mask(words, suspects, len(found))
        hits = np.zeros(len(found), bool)
        for r, hashes in zip(repeated["range"].to_pylist(), repeated["hashes"].to_pylist()):
            own = np.nonzero(wanted & (upper == r))[0]
            hits[own] |= is_among(found[own], unpack_ascending(hashes, "u8"))
        change = np.zeros(len(words.hashes) + 1, np.int64)
        starts = np.nonzero(hits)[0]
        np.add.at(change, starts, 1)
        np.add.at(change, starts + window, -1)
        gone = np.cumsum(change[:-1]) > 0
        out = []
        for row, text, start, end in zip(suspects, words.texts, words.starts, words.ends):
            cut = gone[start:end]
            if cut.any():
                kept = b" ".join([w for w, c in zip(split_words(text), cut) if not c])
                out.append(
                    {
                        "part": row["part"],
                        "row": row["row"],
                        "n_removed": int(cut.sum()),
                        "sha256": hashlib.sha256(kept).hexdigest(),
                        "removed": [
                            {"start": int(s), "end": int(e)} for s, e in _spans(cut)
                        ],
                    }
                )
        span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        return pa.Table.from_pylist(
            out,
            pa.schema(
                [
                    ("part", pa.int64()),
                    ("row", pa.int64()),
                    ("n_removed", pa.int64()),
                    ("sha256", pa.string()),
                    ("removed", pa.list_(span)),
                ]
            ),
        )

    return run


def remove_repeats(
    documents: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, removed`` for each row of ``documents``.

    A word goes if a window over it has a word sequence that also starts anywhere
    else, in the same document or another; windows are judged on the input.
    ``removed`` lists the word ranges that go (end exclusive), ``kept_sha256`` is over
    the kept words joined by one space, in UTF-8.

    Null and empty texts, and those of white space, have no words.  Repeated rows are
    documents each, so their windows repeat; a null id stays null; other columns are
    ignored, whatever their names; an empty table gives an empty result.
    """
    block = (window + 1) // 2
    plain = documents.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text")
    )
    texts = materialize(_parts(plain), "texts")
    long_texts = texts.where(F.col("n_words") >= window)
    total = long_texts.agg(F.sum("n_words")).first()[0] or 0
    ranges = max(LEAST_RANGES, total // RANGE_WORDS)

    anchors = long_texts.select("part", "n_words", "packed").mapInArrow(
        _anchor_rows(block, ranges), _HASH_ROWS
    )
    found = "part long, range int, hashes binary"
    hot = anchors.groupBy("range").applyInPandas(_repeated("u4", True), found)
    suspects = materialize(
        long_texts.select("part", "row", "n_words", "packed")
        .groupBy("part")
        .cogroup(hot.groupBy("part"))
        .applyInArrow(
            _hot_places(window, block, ranges),
            "part long, row long, n_words long, packed binary, candidates binary",
        ),
        "suspects",
    )
    repeated = (
        suspects.mapInArrow(_window_rows(window, ranges), _HASH_ROWS)
        .groupBy("range")
        .applyInPandas(_repeated("u8", False), found)
    )
    removed = (
        suspects.groupBy("part")
        .cogroup(repeated.groupBy("part"))
        .applyInArrow(
            _removed(window, ranges),
            "part long, row long, n_removed long, sha256 string, "
            "removed array<struct<start:int,end:int>>",
        )
    )
    return (
        texts.select("part", "row", "doc_id", "n_words", "all_sha256")
        .join(removed, ["part", "row"], "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
            F.coalesce("sha256", "all_sha256").alias("kept_sha256"),
            F.coalesce("removed", F.expr("array()").cast("array<struct<start:int,end:int>>")).alias(
                "removed"
            ),
        )
    )
