"""Each stage of the pipeline against brute force on what its predecessor kept."""

import duckdb
import pytest
from pyspark.sql import functions as F
from tests.llm import test_decontamination, test_jaccard_join
from tests.llm.fixtures import words
from tests.llm.test_tokens import WORD, check_pieces

import __spark_entry__ as spark_entry
import corpus_pipeline
from wattloom.llm.queries import QUERIES
from wattloom.llm.secret_scan import find_secrets, redacted
from wattloom.workspace import materialize


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(materialize(stage(spark, kept[-1], sf_dir), name))
    return kept


def texts(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_columns_are_those_of_documents(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_toxic_documents_go(spark, sf_dir, stages):
    scores = {r["doc_id"]: r["predicted"] for r in QUERIES["op4_toxicity"](spark, sf_dir).collect()}
    assert texts(stages[1]) == [x for x in texts(stages[0]) if not scores[x[0]]]


def test_one_of_each_class_stays(stages):
    rows = texts(stages[1])
    classes = test_jaccard_join.by_hand(rows)
    keep = {k for k, _, component, _ in classes if k == component}
    assert texts(stages[2]) == [r for r in rows if r[0] in keep]


def test_contaminated_documents_go(sf_dir, stages):
    items = duckdb.connect().execute(f"SELECT * FROM '{sf_dir}/benchmark.parquet'").fetchall()
    rows = texts(stages[2])
    found = {k for k, *_ in test_decontamination.by_hand(rows, items)}
    found |= {k for k, *_ in test_decontamination.whole_by_hand(rows, items)}
    assert texts(stages[3]) == [r for r in rows if r[0] not in found]


def test_secrets_are_replaced(stages):
    spans = find_secrets(stages[3], carry=("text",)).select(
        "doc_id", redacted(F.col("text"), F.col("spans")).alias("text")
    )
    assert texts(stages[4]) == texts(spans)
    assert all(r["n_chars"] == len(r["text"]) for r in stages[4].collect())


def test_everything_kept_is_packed(spark, sf_dir, stages):
    check_pieces(texts(stages[4]), stages[5].collect(), WORD, 2048, 1)
    assert spark_entry.queries()["pipeline"](spark, sf_dir).columns == stages[5].columns


def test_stages_take_awkward_rows(spark, sf_dir):
    rows = [(None, "no id"), (None, "no id"), (1, None), (2, ""), (3, "x y"), (3, "x y"), (4, "X  Y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit("s").alias("source"),
        F.lit(None).cast("long").alias("n_chars"), F.lit(0).alias("score"), F.lit(0).alias("ref"),
    )
    for part in (docs, docs.limit(0)):
        kept = part
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = materialize(stage(spark, kept, sf_dir), name)
            assert kept.dtypes == docs.dtypes
        left = [tuple(r)[:2] for r in kept.collect()]
        want = [(None, "no id"), (1, None), (2, ""), (3, "x y")] if part is docs else []
        assert sorted(left, key=str) == sorted(want, key=str)
        corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir).collect()


def test_rows_are_told_apart_by_place_not_by_id(spark, sf_dir):
    items = duckdb.connect().execute(f"SELECT text FROM '{sf_dir}/benchmark.parquet' LIMIT 2").fetchall()
    passage = items[0][0]
    one, two, three = (" ".join(words(i, 40, 10**6)) for i in (1, 2, 3))
    rows = [(1, one), (1, two), (None, three), (None, three), (None, two + " and"), (None, one), (7, three)]
    rows += [(2, passage), (2, "clean text"), (None, passage + " x"), (None, "clean too"), (2, "clean text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", "text", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"),
        F.lit(1).cast("long").alias("n_chars"), F.lit("clash").alias("place"), F.lit(0).alias("file"),
    )
    # Of each class, the least id stays, one with an id before one without.
    left = corpus_pipeline.near_copies(spark, docs, sf_dir)
    assert left.dtypes == docs.dtypes
    by_index = [(i, t) for i, (_, t) in enumerate(rows)]
    classes = {}
    for i, _, component, _ in test_jaccard_join.by_hand(by_index):
        classes.setdefault(component, []).append(rows[i])
    want = [min(own, key=lambda r: (r[0] is None, r[0] or 0)) for own in classes.values()]
    got = [(r["doc_id"], r["text"]) for r in left.collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and (1, one) in got and (1, two) in got
    # Contaminated rows go, others of their id stay.
    kept = corpus_pipeline.decontamination(spark, materialize(docs, "rows"), sf_dir)
    assert kept.dtypes == docs.dtypes
    found = {i for i, *_ in test_decontamination.by_hand(by_index, list(enumerate(x[0] for x in items)))}
    want = [r for i, r in enumerate(rows) if i not in found]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(want, key=str)
    assert len(want) == len(rows) - 2


def test_very_long_texts_pass_all_stages(spark, sf_dir):
    long = " ".join(words(5, 60_000, 10**5))
    rows = [(1, long), (2, long + " more"), (3, "short text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars")
    )
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = materialize(stage(spark, kept, sf_dir), name)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir).collect()
    check_pieces(texts(kept), pieces, WORD, 2048, 1)


def test_readers_hold_few_long_texts_at_a_time(spark, sf_dir):
    key = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(key)
    try:
        for own, then in (("4096", "512"), ("300", "300")):
            spark.conf.set(key, own)
            docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(1)
            corpus_pipeline.secrets(spark, docs, sf_dir)
            assert spark.conf.get(key) == then
    finally:
        spark.conf.set(key, before)
