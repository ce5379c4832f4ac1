"""Token-id files: one zstandard frame per document with a shared dictionary.

A folder holds

* ``dictionary-<sha256>.zdict``: the dictionary, trained on serialized id arrays, or
  some of these arrays as they are where they are too few to train on; absent only if
  there are none;
* ``part-<number>-<attempt>.tok``: the magic ``WTOK0001``, the dictionary's SHA-256
  (32 bytes, zeros without one), then one frame per document;
* ``part-<number>-<attempt>.idx``: the same head, then one fixed-width entry per
  document (:data:`ENTRY`), so a short document is read with one seek;
* ``manifest``: a Parquet table with one row per part.  Files of failed or repeated
  attempts are not in it and are never read.

Ids are little-endian unsigned 32-bit integers.  Documents ascend by id through
the parts in the order of their numbers.
"""

from __future__ import annotations

import hashlib
import posixpath
import uuid
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattloom.llm.columns import chosen_by_hash
from wattloom.llm.memory import frugal
from wattloom.llm.pretokens import text_encoder

MAGIC = b"WTOK0001"
# Fixed-width index entry; ``start`` counts the ids of earlier documents of the part.
ENTRY = np.dtype(
    [
        ("has_id", "u1"),
        ("doc_id", "<i8"),
        ("start", "<u8"),
        ("n_tokens", "<u8"),
        ("offset", "<u8"),
        ("size", "<u8"),
    ]
)
LEVEL = 1
# The dictionary is fit on about so many documents, never over twice as many, of at most so
# many bytes of text, chosen by a hash of id and text.  It changes the size of the files only.
DICTIONARY_BYTES = 64 * 1024
DICTIONARY_DOCUMENTS = 1_000
DICTIONARY_TEXT_BYTES = 16 * 1024
# The library takes no shorter content as a dictionary.
LEAST_DICTIONARY = 8

_MANIFEST = "part int, file string, documents long, tokens long, bytes long"
_READ_BYTES = 4 << 20


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def train_dictionary(documents: DataFrame, tokenizer: str, end_id: int) -> bytes:
    """Dictionary of serialized id arrays; empty if there are no arrays to speak of.

    Arrays too few for the library to train on are the dictionary themselves: a frame
    can refer to any content.  ``documents`` has the columns ``doc_id`` and ``text``.
    """
    short = documents.where(F.octet_length("text") <= DICTIONARY_TEXT_BYTES)
    share = DICTIONARY_DOCUMENTS / max(1, documents.count())
    rows = (
        short.where(chosen_by_hash(share, "doc_id", "text"))
        .select("text")
        .limit(2 * DICTIONARY_DOCUMENTS)
        .collect()  # bounded by the two parameters: 32 MB
    )
    rows.sort()
    encoder = text_encoder(tokenizer)
    end = end_id.to_bytes(4, "little")
    samples = [encoder.ids(r["text"]) + end for r in rows]
    if sum(map(len, samples)) >= 8 * DICTIONARY_BYTES:
        with suppress(zstandard.ZstdError):  # arrays without anything in common
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    content = b"".join(samples)[-DICTIONARY_BYTES:]
    return content if len(content) >= LEAST_DICTIONARY else b""


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def _digest(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest() if dictionary else bytes(32)


def write_token_files(
    documents: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode every whole text, append ``end_id`` and write the files to ``folder``.

    ``folder`` is a new path or URI of storage that all machines share.  Null and
    empty texts hold the end id alone.  A null id comes first; rows of one id are
    ordered by a hash of their text, and each is a document of its own.  Other
    columns are ignored, whatever their names.  An empty table gives an empty manifest.
    """
    spark = documents.sparkSession
    plain = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    dictionary = train_dictionary(plain, tokenizer, end_id)
    store, path = _open(folder)
    store.create_dir(path, recursive=True)
    if dictionary:
        with store.open_output_stream(
            posixpath.join(path, f"dictionary-{_digest(dictionary).hex()}.zdict")
        ) as out:
            out.write(dictionary)
    shared = spark.sparkContext.broadcast(dictionary)
    end = end_id.to_bytes(4, "little")

    @frugal
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(tokenizer)
        frame = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(shared.value)).compress
        head = MAGIC + _digest(shared.value)
        part = TaskContext.get().partitionId()
        name = f"part-{part:07d}-{uuid.uuid4().hex}"
        files, folder_path = _open(folder)
        entries, tokens, offset, data = [], 0, len(head), None
        for batch in batches:
            for key, own_ids in zip(batch["doc_id"], encoder.batch_ids(batch["text"])):
                if data is None:
                    data = files.open_output_stream(posixpath.join(folder_path, f"{name}.tok"))
                    data.write(head)
                ids = own_ids + end
                packed = frame(ids)
                data.write(packed)
                own = key.as_py()
                entries.append((own is not None, own or 0, tokens, len(ids) // 4, offset, len(packed)))
                tokens += len(ids) // 4
                offset += len(packed)
        if data is None:
            return
        data.close()
        with files.open_output_stream(posixpath.join(folder_path, f"{name}.idx")) as index:
            index.write(head)
            index.write(np.array(entries, ENTRY).tobytes())
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "file": name, "documents": len(entries), "tokens": tokens, "bytes": offset}],
            pa.schema(
                [("part", pa.int32()), ("file", pa.string()), ("documents", pa.int64()),
                 ("tokens", pa.int64()), ("bytes", pa.int64())]
            ),
        )

    keys = ["doc_id", "h"]
    manifest = (
        plain.withColumn("h", F.xxhash64("text"))
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("doc_id", "text")
        .mapInArrow(write, _MANIFEST)
    )
    manifest.write.parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files of ``folder``.

    ``start`` counts the ids of all documents before it; ``ids`` are the raw
    little-endian unsigned 32-bit integers.
    """
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    # One short row per file.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select(
        "part", "file", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base")
    )
    names = ["doc_id", "start", "n_tokens", "ids"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    @frugal
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from documents_of(row["file"], row["base"])

    def documents_of(name: str, base: int) -> Iterator[pa.RecordBatch]:
        store, path = _open(folder)
        with store.open_input_stream(posixpath.join(path, f"{name}.idx")) as file:
            index = file.read()
        digest = index[len(MAGIC) : len(MAGIC) + 32]
        if index[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{name}.idx is no index of token files")
        dictionary = b""
        if any(digest):
            with store.open_input_stream(
                posixpath.join(path, f"dictionary-{digest.hex()}.zdict")
            ) as file:
                dictionary = file.read()
            if _digest(dictionary) != digest:
                raise ValueError(f"the dictionary of {name} is not the one it was written with")
        expand = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress
        entries = np.frombuffer(index, ENTRY, offset=len(MAGIC) + 32)
        with store.open_input_stream(posixpath.join(path, f"{name}.tok")) as data:
            if data.read(len(MAGIC) + 32) != index[: len(MAGIC) + 32]:
                raise ValueError(f"{name}.tok does not belong to its index")
            rows, held = [], 0
            for entry in entries:
                ids = expand(data.read(int(entry["size"])), max_output_size=4 * int(entry["n_tokens"]))
                own = int(entry["doc_id"]) if entry["has_id"] else None
                rows.append((own, base + int(entry["start"]), int(entry["n_tokens"]), ids))
                held += len(ids)
                if held >= _READ_BYTES:
                    yield columns(rows)
                    rows, held = [], 0
            if rows:
                yield columns(rows)

    def columns(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)], names
        )

    width = max(1, manifest.count())
    return files.repartition(width, "part").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids binary"
    )


def read_document(folder: str, file: str, position: int) -> bytes:
    """Ids of one document by its place in a part's index: one seek in each file."""
    store, path = _open(folder)
    head = len(MAGIC) + 32
    with store.open_input_file(posixpath.join(path, f"{file}.idx")) as index:
        index.seek(len(MAGIC))
        digest = index.read(32)
        index.seek(head + position * ENTRY.itemsize)
        entry = np.frombuffer(index.read(ENTRY.itemsize), ENTRY)[0]
    dictionary = b""
    if any(digest):
        with store.open_input_stream(posixpath.join(path, f"dictionary-{digest.hex()}.zdict")) as f:
            dictionary = f.read()
    with store.open_input_file(posixpath.join(path, f"{file}.tok")) as data:
        data.seek(int(entry["offset"]))
        packed = data.read(int(entry["size"]))
    return zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress(packed)
