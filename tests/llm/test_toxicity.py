"""Toxicity scores: held-out accuracy, and labels that must not matter."""

import random
import zlib

import pytest
from pyspark.sql import functions as F
from tests.llm.fixtures import awkward_texts, documents, words

from wattloom.llm import toxicity
from wattloom.llm.queries import QUERIES
from wattloom.llm.toxicity import FEATURES, _Codes, text_features, toxicity_scores

BAD = ["grobnik", "grobnal", "zzafen", "plurk", "skeef"]


def corpus(n):
    draw = random.Random(3)
    texts, labels = [], []
    for i in range(n):
        own, bad = words(i, draw.randrange(20, 200), 900), i % 5 == 0
        if bad:
            for _ in range(draw.randrange(2, 6)):
                own.insert(draw.randrange(len(own)), draw.choice(BAD))
        texts.append(" ".join(own))
        labels.append(int(bad))
    return texts, labels


def held_out(k):
    return zlib.crc32(str(k).encode()) % 5 == 0


@pytest.fixture(scope="module")
def scored(spark):
    texts, labels = corpus(600)
    texts += awkward_texts() + [texts[5]]
    docs = documents(spark, texts).withColumn("score", F.lit("clash"))
    rows = [(i, x) for i, x in enumerate(labels)] + [(0, 1), (None, 1), (3, None), (10**6, 1)]
    table = spark.createDataFrame(rows, "doc_id long, toxic int").withColumn("text", F.lit("x"))
    return texts, labels, docs, rows, toxicity_scores(docs, table).collect()


def test_held_out_rows_are_told_apart(scored):
    texts, labels, _, _, got = scored
    assert len(got) == len(texts)
    by_id = {r["doc_id"]: r for r in got}
    assert all(r["held_out"] == held_out(k) for k, r in by_id.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    judged = [k for k in range(len(labels)) if held_out(k)]
    right = sum(by_id[k]["predicted"] == labels[k] for k in judged)
    assert len(judged) > 80 and right >= 0.97 * len(judged)
    assert by_id[len(texts) - 1]["score"] == by_id[5]["score"]
    assert by_id[601]["predicted"] == 0


def test_held_out_labels_are_never_read(spark, scored):
    _, _, docs, rows, got = scored
    flipped = [(k, 1 - x if k is not None and x is not None and held_out(k) else x) for k, x in rows]
    table = spark.createDataFrame(flipped, "doc_id long, toxic int")
    again = toxicity_scores(docs.repartition(3), table.repartition(2)).collect()
    key = lambda r: r["doc_id"]
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str), key


def test_query_on_the_given_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = QUERIES["op4_toxicity"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").select("toxic", "predicted").collect()
    assert sum(a == b for a, b in rows) >= 0.93 * len(rows)
    assert got.count() == 1000


def test_without_labels_of_both_kinds(spark):
    docs = documents(spark, ["a b", None, "c"])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity_scores(docs, none).collect()} == {0.0}
    one = spark.createDataFrame([(k, 1) for k in range(3)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity_scores(docs, one).collect()} == {1.0}
    assert toxicity_scores(documents(spark, []), one).count() == 0


def test_features_of_a_text():
    codes = _Codes(frozenset({"idiot", "^morr"}), frozenset({"meh"}))
    text = "You IDIOT! x 1d10t, moooorrrron meh? plain words here, thy end."
    f = dict(zip(FEATURES, text_features(text, codes)))
    assert f["strong_density"] == pytest.approx(100 * 2 / 11)
    assert f["weak_density"] == pytest.approx(100 / 11)
    assert f["strong_near_second_person"] > 0 and f["second_person"] == pytest.approx(100 / 11)
    assert f["capital_words"] == pytest.approx(100 / 11) and f["obfuscated"] == pytest.approx(100 / 11)
    assert f["stretched"] == pytest.approx(100 / 11)
    assert text_features(None, codes) == text_features(" \n", codes) == [0.0] * len(FEATURES)


def test_a_small_cache_changes_nothing(monkeypatch):
    text = " ".join(words(4, 400) + ["grobnik"])
    lexicon = (frozenset({"grobnik"}), frozenset())
    want = text_features(text, _Codes(*lexicon))
    monkeypatch.setattr(toxicity, "CACHE_LIMIT", 3)
    assert text_features(text, _Codes(*lexicon)) == want
