"""Near-duplicate classes against all pairs by brute force."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm.fixtures import awkward_texts, documents, words
from tests.llm.test_tokens import rows_of

from wattloom.llm import jaccard_join
from wattloom.llm.components import components
from wattloom.llm.jaccard_join import adaptive_length, links_of, near_duplicates, prefix_order
from wattloom.llm.queries import QUERIES

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_by_hand(rows, size=5):
    out = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
        n = max(1, len(w) - size + 1) if w else 0
        out.append({tuple(w[i : i + size]) for i in range(n)})
    return out


def by_hand(rows, size=5, percent=80):
    sets = sets_by_hand(rows, size)
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                parent[find(i)] = find(j)
                links[i] += 1
                links[j] += 1
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return sorted(
        ((k, len(s), least.get(find(i)), links[i]) for i, ((k, _), s) in enumerate(zip(rows, sets))),
        key=str,
    )


def edited(seed, base, edits):
    draw, own = random.Random(seed), list(base)
    for _ in range(edits):
        at, kind = draw.randrange(len(own)), draw.randrange(3)
        if kind == 0:
            own[at] = f"e{seed}x{draw.randrange(10**6)}"
        elif kind == 1:
            own.insert(at, f"i{draw.randrange(50)}")
        else:
            del own[at]
    return " ".join(own)


def test_query_equals_brute_force(spark, sf_dir):
    got = QUERIES["op3_jaccard_join"](spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == by_hand(rows_of(sf_dir))


@pytest.mark.parametrize(("block", "part"), [(3, 200), (256, 10**6)])
def test_groups_of_near_copies(spark, monkeypatch, block, part):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "PART_WORDS", part)
    bases = [words(i, n, 3000) for i, n in enumerate((30, 60, 60, 200, 12, 8))]
    texts = [edited(100 * b + i, bases[b], i % 5) for b in range(6) for i in range(12)]
    passage = " ".join(words(50, 40, 3000))
    texts += [passage + " " + " ".join(words(60 + i, 12 + i, 3000)) for i in range(12)]
    texts += [texts[0].upper(), texts[0].replace(" ", "\n"), texts[1], "a b", "A  B", "a b c d"]
    texts += awkward_texts() + ["a b c d e f g h i j k l m n"] * 3
    rows = list(enumerate(texts)) + [(None, texts[5]), (None, "only one"), (4, texts[4])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumn("component_id", F.lit("clash")).repartition(5)
    got = sorted(map(tuple, near_duplicates(df).collect()), key=str)
    assert got == by_hand(rows)


def test_lower_threshold_and_longer_shingles(spark):
    base = words(9, 120, 3000)
    texts = [edited(i, base, i) for i in range(20)]
    got = sorted(map(tuple, near_duplicates(documents(spark, texts), 3, 50).collect()), key=str)
    assert got == by_hand(list(enumerate(texts)), 3, 50)


def test_empty_table(spark):
    assert near_duplicates(documents(spark, [])).count() == 0
    assert near_duplicates(documents(spark, [None, "", "x"])).count() == 3


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(50, 95))
def test_links_lose_no_pair(seed, percent):
    draw = random.Random(seed)
    universe = list(range(1, 80))
    bases = [draw.sample(universe, 30) for _ in range(3)]
    sets = []
    for i in range(16):
        own = set(bases[i % 3]) - set(draw.sample(universe, draw.randrange(9)))
        sets.append(np.array(sorted(own | set(draw.sample(universe, draw.randrange(4)))), np.uint64))
    frequency = {x: sum(x in s.tolist() for s in sets) for x in universe}
    rows = []
    for i, s in enumerate(sets):
        df = np.array([frequency[x] if frequency[x] > 1 else 0 for x in s.tolist()])
        order = prefix_order(s, df)
        least = -(-percent * len(s) // 100)
        length = adaptive_length(df[order], len(s) - least + 1, least)
        cut = order[: len(s) - least + length]
        rows.append(
            {
                "ref": i,
                "n": len(s),
                "needs": length,
                "prefix": s[cut[df[cut] > 0]].tobytes(),
                "shared": s[df > 0].tobytes(),
            }
        )
    links = links_of(rows, None, percent)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(set(a.tolist()) & set(b.tolist()))
            want = i != j and 100 * both >= percent * (len(a) + len(b) - both)
            assert links[i, j] == want


def test_longer_lists_ask_for_longer_prefixes():
    rare = np.array([0, 0, 2, 2, 2, 900, 900, 900, 900, 900])
    assert adaptive_length(rare, 4, 7) == 2
    assert adaptive_length(np.full(40, 500), 9, 32) > 1


def test_components_of_a_path_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(500, 500 + i) for i in range(1, 80)]
    edges += [(900 + i, 900 + (i + 1) % 9) for i in range(9)] + [(3, 3), (2000, 1999)]
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    want = {i: 1 for i in range(1, 61)} | {i: 500 for i in range(500, 580)}
    want |= {900 + i: 900 for i in range(9)} | {1999: 1999, 2000: 1999}
    assert {r["node"]: r["component"] for r in got} == want
