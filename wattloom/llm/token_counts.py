"""Token counts of whole texts by a two-tier table of pre-token lengths.

Tier one is a table of the corpus' most frequent pre-tokens, broadcast to all
workers; tier two are the workers' own caches, which encode what the table lacks.
No pre-token of a text is ever shuffled.  The table is found over all documents:
each task keeps a bounded summary of its most frequent pre-tokens (lossy
counting), and only the summaries are added up.  The table decides how fast a
length is found, never what it is.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.memory import frugal
from wattloom.llm.pretokens import TextEncoder, text_encoder
from wattloom.workspace import materialize

# Entries of the broadcast table, pre-tokens per task summary, longest entry in characters:
# the table is at most 16,384 entries of 64 characters, about 2 MB.
TABLE_ENTRIES = 16_384
SUMMARY_ENTRIES = 4_096
ENTRY_CHARS = 64
# Bins of counts for each doubling.
BINS = 16

# The encoder of this Python worker and the table it was made with.
_WORKER: dict = {}


def _worker_encoder(tokenizer: str, table: Broadcast) -> TextEncoder:
    if _WORKER.get("tokenizer") != tokenizer or _WORKER.get("table") is not table.value:
        _WORKER.update(
            tokenizer=tokenizer, table=table.value, encoder=TextEncoder(tokenizer, table.value)
        )
    return _WORKER["encoder"]


def frequent_pretokens(documents: DataFrame, tokenizer: str, text: str = "text") -> dict[str, int]:
    """Token lengths of the most frequent pre-tokens."""

    @frugal
    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(tokenizer)
        seen: Counter = Counter()
        for batch in batches:
            for value in batch["text"]:
                for pieces in encoder.pretokens(value.as_py()):
                    seen.update(pieces)
                if len(seen) > 64 * SUMMARY_ENTRIES:
                    seen = Counter(dict(seen.most_common(16 * SUMMARY_ENTRIES)))
        top = [(p, n) for p, n in seen.most_common(SUMMARY_ENTRIES) if len(p) <= ENTRY_CHARS]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
            ["pretoken", "n"],
        )

    texts = documents.select(F.col(text).cast("string").alias("text"))
    counts = materialize(
        texts.mapInArrow(summarize, "pretoken string, n long")
        .groupBy("pretoken")
        .agg(F.sum("n").alias("n")),
        "pretokens",
    )
    # The table takes whole bins of counts, from the greatest down, as long as they fit.
    counts = counts.withColumn("bin", F.floor(F.log2("n") * BINS).cast("int"))
    entries, least = 0, None
    # At most 64 * BINS rows.
    for row in sorted(counts.groupBy("bin").count().collect(), reverse=True):
        entries += row["count"]
        if entries > TABLE_ENTRIES:
            break
        least = row["bin"]
    if least is None:
        return {}
    rows = counts.where(F.col("bin") >= least).select("pretoken").collect()  # TABLE_ENTRIES at most
    encoder = text_encoder(tokenizer)
    return {r["pretoken"]: len(encoder.piece_ids(r["pretoken"])) // 4 for r in rows}


def token_counts(
    documents: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` for each row of ``documents``.

    ``tokenizer`` is the path of a ``tokenizers`` file, the same on every machine.
    Null and empty texts have 0 bytes and tokens; a null id stays null; repeated
    rows give repeated results; other columns are ignored, whatever their names;
    an empty table gives an empty result.
    """
    table = documents.sparkSession.sparkContext.broadcast(
        frequent_pretokens(documents, tokenizer, text)
    )

    @frugal
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_encoder(tokenizer, table)
        for batch in batches:
            counts = [encoder.count(value.as_py()) for value in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["n_bytes"], pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    kind = documents.schema[doc_id].dataType.simpleString()
    return documents.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    ).mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
