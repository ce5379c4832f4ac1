"""Corpus preparation in five stages, from raw documents to packed sequences.

Each stage works on what its predecessor kept and returns documents of the same
columns, but for the last, which returns pieces of packed sequences:

1. toxicity: documents predicted toxic go;
2. near duplicates: of each class of near copies one document stays, the one of least id;
3. decontamination: documents that hold a benchmark passage go;
4. secrets: secrets are replaced in the texts, all documents stay;
5. packing: texts become token sequences.

Stages 2 and 3 know a row by its file and its place in it, not by its id: rows that share
an id, and rows without one, are documents each.  Of near copies with and without an
id, one with the least id stays.  No stage drops or changes a row for a null in any
column, an empty or a very long text, a tie or a clashing extra column; equal rows are
near copies of each other, unless they have no words, and an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm import prepare
from wattloom.llm.columns import if_small
from wattloom.llm.decontamination import contaminated
from wattloom.llm.jaccard_join import near_duplicates
from wattloom.llm.packing import pack_documents
from wattloom.llm.secret_scan import find_secrets, redacted
from wattloom.llm.toxicity import toxicity_scores
from wattloom.workspace import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the labels are those of the corpus."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = toxicity_scores(docs, labels, carry=tuple(docs.columns))
    return scores.where("predicted = 0").select("row.*")


def with_places(docs: DataFrame) -> DataFrame:
    """``docs`` as stored, with the column ``place``: file and row number of each row.

    Both outlive any executor and do not depend on how the files are split into tasks.
    A table that is not read from files is stored first.
    """
    place = F.struct(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    ).alias("place")
    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    try:
        return docs.select(columns, place)
    except AnalysisException:
        return materialize(docs, "docs").select(columns, place)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one of least id."""
    prepare(spark)
    placed = with_places(docs)
    own_id = F.col("doc.doc_id")
    key = F.struct(own_id.isNull().alias("unnamed"), own_id.alias("id"), "place")
    classes = near_duplicates(placed.select(key.alias("doc_id"), F.col("doc.text").alias("text")))
    first = classes.where("doc_id = component_id").select("doc_id.place")
    return placed.join(first, "place", "left_semi").select("doc.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    prepare(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    placed = with_places(docs)
    texts = placed.select("place", F.col("doc.text").alias("text"))
    found = materialize(
        contaminated(texts, benchmark, doc_id="place").select(F.col("doc_id").alias("place")).distinct(), "leaks"
    )
    return placed.join(if_small(found), "place", "left_anti").select("doc.*")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced and ``n_chars`` counted anew."""
    prepare(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    found = find_secrets(docs, carry=("text", *others))
    text = redacted(F.col("text"), F.col("spans"))
    found = found.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))
    return found.select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2,048 tokens."""
    prepare(spark)
    # A smaller cache than by itself, since workers still hold what earlier stages left.
    return pack_documents(
        docs,
        public_tokenizers.path("word_bpe_49k.json"),
        size=2048,
        end_id=1,
        with_ids=False,
        cache=150_000,
    )


STAGES = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

# Boosted trees and token ids have no SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each is stored and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
