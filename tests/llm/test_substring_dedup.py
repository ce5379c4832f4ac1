"""Repeated windows against a brute-force count."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.fixtures import awkward_texts, documents, words

from wattloom.llm import substring_dedup
from wattloom.llm import words as word_tools
from wattloom.llm.queries import QUERIES
from wattloom.llm.substring_dedup import remove_repeats
from tests.llm.test_tokens import rows_of


def by_hand(rows, window):
    split = [(k, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in rows]
    seen = Counter(
        tuple(w[i : i + window]) for _, w in split for i in range(len(w) - window + 1)
    )
    out = []
    for k, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((k, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark, sf_dir):
    got = QUERIES["op7_substring_dedup"](spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == by_hand(rows_of(sf_dir), 35)


@pytest.mark.parametrize("window", [1, 2, 5, 8])
def test_equals_brute_force_on_few_words(spark, monkeypatch, window):
    monkeypatch.setattr(substring_dedup, "PART_WORDS", 60)
    draw = random.Random(window)
    texts = [" ".join(words(i, draw.randrange(60), 9 if i % 3 else 200)) for i in range(60)]
    texts += [texts[3], texts[3], *awkward_texts(), "a b\x0bc\x0cd\re", "a b c d e", "a b c d e"]
    df = documents(spark, texts).withColumn("n_words", F.lit("clash")).repartition(4)
    got = remove_repeats(df, window=window).collect()
    assert sorted((tuple(r)[:4] for r in got), key=str) == by_hand(list(enumerate(texts)), window)
    for r in got:
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]


def test_passage_at_any_offset_is_found(spark):
    passage = words(77, 35)
    texts = [" ".join(words(i, i) + passage + words(1000 + i, 40 - i)) for i in range(36)]
    got = remove_repeats(documents(spark, texts)).collect()
    assert sorted((tuple(r)[:4] for r in got), key=str) == by_hand(list(enumerate(texts)), 35)
    assert all(r["n_removed"] >= 35 for r in got)


def test_empty_table_and_null_ids(spark):
    assert remove_repeats(documents(spark, [])).count() == 0
    df = spark.createDataFrame([(None, " ".join(words(1, 40)))] * 2, "doc_id long, text string")
    assert [r["n_removed"] for r in remove_repeats(df).collect()] == [40, 40]


def test_packed_numbers_come_back():
    for kind in ("u4", "u8"):
        values = np.unique(np.random.default_rng(1).integers(0, 2**32, 500).astype(kind))
        assert (word_tools.unpack_ascending(word_tools.pack_ascending(values), kind) == values).all()


def test_rolling_hashes_depend_on_the_words_alone():
    own, _ = word_tools.hash_words(" ".join(words(5, 300)).encode())
    whole = word_tools.rolling_hashes(own, 7, substring_dedup._FULL_BASE)
    alone = word_tools.rolling_hashes(own[100:107], 7, substring_dedup._FULL_BASE)
    assert whole[100] == alone[0] and len(set(whole.tolist())) == 294


def test_word_hashes_depend_on_the_words_alone(monkeypatch):
    own = [w.encode() for w in words(6, 200)] + [b"x" * 300, b"\xc3\xa9", b"a", b"aa"]
    text = b" \t" + b"\r\n ".join(own) + b"\x0b"
    whole, starts = word_tools.hash_words(text)
    assert [text[s : s + len(w)] for s, w in zip(starts, own)] == own
    alone = [word_tools.hash_words(w)[0][0] for w in own]
    assert whole.tolist() == alone and len(set(alone)) == len(set(own))
    monkeypatch.setattr(word_tools, "BYTES_AT_ONCE", 16)
    blocks, again = word_tools.hash_words(text)
    assert (blocks == whole).all() and (again == starts).all()
    hashes, counts = word_tools.hash_texts([b"", b"a b", b" ", text, b"c"])
    assert counts.tolist() == [0, 2, 0, len(own), 1]
    assert hashes[2:-1].tolist() == alone
    assert [len(x) for x in word_tools.hash_words(b" \n")] == [0, 0]
