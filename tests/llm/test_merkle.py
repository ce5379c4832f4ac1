"""Merkle manifest against a plain tree, with repeated ids, nulls, wide ids and tall trees."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from tests.llm.fixtures import awkward_texts, words

from wattloom.llm import merkle, queries
from wattloom.llm.merkle import folded, leaf_hash, merkle_manifest, siblings

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, tampered=False):
    k, text, lang, source, n = row
    text = text.translate(LOWER) if tampered and text is not None else text
    fields = [None if x is None else str(x) for x in (k, source, lang, n, text)]
    return sha("".join("-" if x is None else f"{len(x.encode())}:{x}" for x in fields))


def proofs(nodes):
    """Root, and the siblings left and right of each node by level."""
    paths, spots = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, spot in zip(paths, spots):
            run = spot - spot % 16
            path.append(("".join(nodes[run:spot]), "".join(nodes[spot + 1 : run + 16])))
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        spots = [s // 16 for s in spots]
    return nodes[0], paths


def by_hand(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: proofs([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order}
    root, tops = proofs([trees[s][0] for s in order])
    found = []
    for source, top in zip(order, tops):
        subroot, paths = trees[source]
        for (named, k, leaf, row), path in zip(sorted(groups[source], key=lambda x: x[:3]), paths):
            whole = path + top
            node = leaf_of(row, True) if named and zlib.crc32(str(k).encode()) % 5 == 0 else leaf
            for left, right in whole:
                node = sha(left + node + right)
            proof = sha("".join(a + b for a, b in whole))
            found.append((row[0], leaf, subroot, root, proof, node, node == root))
    return sorted(found, key=str)


def applied(spark, rows, monkeypatch, parts=3):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumns(
        {"tree": F.lit("clash"), "rank": F.lit(1), "leaf": F.lit(None).cast("long"), "word": F.lit(0.5)}
    )
    monkeypatch.setattr(queries, "_table", lambda *_: docs)
    return sorted((tuple(r) for r in queries.QUERIES["op11_merkle_manifest"](spark, "").collect()), key=str)


def test_awkward_rows_by_hand(spark, monkeypatch):
    rows = [(i, t, "en", f"s{i % 3}", None if i % 2 else i) for i, t in enumerate(awkward_texts())]
    rows += [(i, " ".join(words(i, 9)).title(), None, f"t{i}", 5) for i in range(20)]
    rows += [(i, "Only ONE", "en", None, 1) for i in range(17)] + [(3, "x", "de", "", 1), (3, "x", "de", "é", 1)]
    # One id many times: equal rows, different rows, and rows without an id.
    rows += [(40, f"Text {i % 7}", "en", "hot", 1) for i in range(60)]
    rows += [(None, f"Text {i % 5}", "en", "hot", 1) for i in range(23)]
    rows += [(i, "Y", "en", "hot", 1) for i in (39, 41, 41, -1, -64, 63, 64, -(2**63), 2**63 - 1)]
    monkeypatch.setattr(merkle, "_COPIES_AT_ONCE", 4)
    assert applied(spark, rows, monkeypatch) == by_hand(rows)


def test_close_leaves_of_one_id(spark, monkeypatch):
    rows = [(7, f"Text {i % 40}", "en", "a", 1) for i in range(70)] + [(i, "z", "en", "a", 1) for i in range(9)]
    monkeypatch.setattr(merkle, "_PREFIX_DIGITS", 1)
    assert applied(spark, rows, monkeypatch) == by_hand(rows)


def test_tall_trees_and_wide_ids(spark, monkeypatch):
    draw = random.Random(5)
    ids = draw.sample(range(12_000), 4_600) + [draw.randrange(-(2**62), 2**62) for _ in range(300)]
    rows = [(k, f"Doc {k}", "en", "big" if i % 8 else f"s{i % 24}", i) for i, k in enumerate(ids)]
    assert applied(spark, rows, monkeypatch) == by_hand(rows)


@pytest.mark.parametrize("rows", [[], [(5, "A", "en", "s", 1)], [(None, None, None, None, None)]])
def test_tiny_tables(spark, monkeypatch, rows):
    assert applied(spark, rows, monkeypatch) == by_hand(rows) if rows else applied(spark, rows, monkeypatch) == []


def test_positions_and_paths(spark):
    rows = [(k, f"T{k}", "en", "s", 1) for k in range(40, 0, -1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    leaf = leaf_hash(F.col("doc_id"), F.col("text"))
    got = merkle_manifest(docs, leaf, carry={"text": F.col("text")})
    good = folded(F.col("leaf"), F.col("path")) == F.col("root")
    got = got.select("*", good.alias("good"), F.length(siblings(F.col("path"))).alias("n")).collect()
    assert {r["position"]: r["doc_id"] for r in got} == {k - 1: k for k in range(1, 41)}
    assert all(r["good"] and r["text"] == f"T{r['doc_id']}" and r["subroot"] == r["root"] for r in got)
    assert {r["n"] for r in got} == {64 * 17, 64 * 9}
