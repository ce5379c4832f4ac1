"""Language identification: held-out accuracy, labels that must not matter, counts and votes by hand."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.fixtures import awkward_texts

from wattloom.llm import language_id
from wattloom.llm.language_id import (
    DIMENSIONS,
    LanguageModel,
    family_of,
    fit_machine,
    language_ids,
    run_counts,
    unit,
)

SCHEMA = "doc_id long, text string, lang string, source string"
SYLLABLES = {
    "en": ["the", "ing", "th", "ea", "wh", "ould", "tion"],
    "de": ["der", "sch", "ung", "ein", "cht", "th", "ea"],
    "es": ["ción", "el", "los", "que", "ar", "ñu"],
    "fr": ["eau", "que", "les", "ou", "ar", "é"],
    "xx": ["kzu", "qom", "rrix"],
}


def text_of(draw, lang, n):
    own = SYLLABLES[lang]
    return " ".join("".join(draw.choices(own, k=draw.randrange(1, 4))) for _ in range(n)).capitalize() + "."


def corpus(n):
    draw = random.Random(11)
    langs = [draw.choice(sorted(SYLLABLES)) for _ in range(n)]
    return [(i, text_of(draw, lang, draw.randrange(6, 80)), lang, "s") for i, lang in enumerate(langs)]


def held_out(k):
    return k is not None and zlib.crc32(str(k).encode()) % 3 == 1


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns(
        {"row": F.lit("clash"), "held_out": F.lit("x"), "score": F.lit(None).cast("string"), "places": F.lit(1)}
    )


@pytest.fixture(scope="module")
def predicted(spark):
    rows = corpus(500)
    awkward = [(1000 + i, t, [None, "en", ""][i % 3], None) for i, t in enumerate(awkward_texts())]
    awkward += [(None, rows[0][1], "fr", "s"), (2, rows[2][1], rows[2][2], "s"), (2000, "12 3½ ²", "de", "s")]
    return rows, awkward, language_ids(table(spark, rows + awkward)).collect()


def test_held_out_rows_are_told_apart(predicted):
    rows, awkward, got = predicted
    assert len(got) == len(rows) + len(awkward)
    assert all(r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in got)
    by_id = {r["doc_id"]: r for r in got}
    judged = [r for r in rows if held_out(r[0])]
    right = sum(by_id[k]["lang_pred"] == lang for k, _, lang, _ in judged)
    assert len(judged) > 120 and right >= 0.97 * len(judged)
    assert by_id[None]["lang_pred"] == by_id[0]["lang_pred"] and sum(r["doc_id"] == 2 for r in got) == 2


def test_texts_without_letters(predicted):
    _, awkward, got = predicted
    by_id = {r["doc_id"]: r for r in got}
    for k, text, _, _ in awkward:
        is_told = text is not None and any(c.isalpha() for c in text)
        assert (by_id[k]["lang_pred"] != "und") == is_told, k
        assert is_told or by_id[k]["score"] == 0


def test_held_out_labels_and_other_columns_are_never_read(spark, predicted):
    rows, awkward, got = predicted
    changed = [
        (k, t, "xx" if held_out(k) or k is None else lang, "other") for k, t, lang, _ in reversed(rows + awkward)
    ]
    again = language_ids(table(spark, changed)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)


def test_nothing_to_learn_from(spark):
    assert language_ids(table(spark, [])).collect() == []
    rows = [(i, "word", None, "s") for i in range(9)] + [(None, "word", "en", "s"), (9, "1", "en", "s")]
    assert {(r["lang_pred"], r["score"]) for r in language_ids(table(spark, rows)).collect()} == {("und", 0.0)}
    one = language_ids(table(spark, [(i, "word", "en", "s") for i in range(9)])).collect()
    assert {r["lang_pred"] for r in one} == {"en"}


def test_bounds_of_the_sample(spark):
    rows = corpus(400)
    model = language_id.learn_languages(table(spark, rows), learn_rows=20, learn_languages=2)
    largest = [lang for lang, _ in sorted(Counter(r[2] for r in rows).items(), key=lambda x: (-x[1], x[0]))[:2]]
    assert sorted(sum(model.languages.values(), [])) == sorted(largest)


def runs_by_hand(text):
    letters = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    padded = (" " + " ".join(letters) + " ") if letters else " "
    return Counter(padded[i : i + k] for k in (2, 3) for i in range(len(padded) - k + 1))


def test_runs_of_whole_texts(monkeypatch):
    texts = ["A b", "Hello,  wörld 12x", "x", "", "  9 ", "日本語 текст", "a" * 40 + "!", "🙂é z"]
    for text in texts:
        whole = run_counts(text)
        assert whole.sum() == runs_by_hand(text).total(), text
        expected = np.zeros(DIMENSIONS, int)
        for run, n in runs_by_hand(text).items():
            one = language_id_place(run)
            expected[one] += n
        assert (whole == expected).all(), text
        for size in (1, 2, 3, 5):
            monkeypatch.setattr(language_id, "CHARACTERS_AT_ONCE", size)
            assert (run_counts(text) == whole).all(), (text, size)
        monkeypatch.undo()


def language_id_place(run):
    counts = np.zeros(DIMENSIONS, np.int64)
    codes = np.array([0 if c == " " else ord(c) for c in run], np.uint32)
    language_id._count_runs(codes, len(codes) - 1, counts, (len(run),))
    return int(counts.argmax())


def test_machine_separates_with_the_best_margin():
    features = unit(np.array([[9.0, 1, 0], [8, 2, 0], [1, 9, 0], [2, 8, 1], [1, 8, 0]]))
    signs = np.array([1.0, 1, -1, -1, -1])
    weights = fit_machine(features, signs)
    rows = np.hstack([features, np.ones((5, 1))])
    share = np.where(signs > 0, 0.4, 0.6)

    def loss(w):
        return w @ w / 2 + (np.maximum(0, 1 - signs * (rows @ w)) ** 2 / share).sum() / 2

    assert (np.sign(rows @ weights) == signs).all()
    draw = np.random.default_rng(1)
    assert all(loss(weights) <= loss(weights + d) + 1e-4 for d in draw.normal(0, 0.02, (200, 4)))


def test_votes_of_three_languages():
    machines = np.zeros((3, DIMENSIONS + 1))
    machines[:, :3] = [[1, -1, 0], [1, 0, -1], [0, 1, -1]]
    model = LanguageModel(["f"], np.zeros((1, DIMENSIONS)), {"f": ["a", "b", "c"]}, {"f": [(0, 1), (0, 2), (1, 2)]}, {"f": machines})
    counts = np.zeros((3, DIMENSIONS), np.int64)
    counts[0, 0] = counts[1, 1] = counts[2, 2] = 5
    assert [name for name, _ in model.predict(counts)] == ["a", "b", "c"]


def test_families():
    assert family_of("en") == family_of("de") != family_of("fr") == family_of("es-MX")
    assert family_of("xx") == family_of("") == "other"
