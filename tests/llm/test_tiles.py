"""Tiles: every pair that shares a token meets once, and rows follow the postings."""

import random
from itertools import combinations

import pytest

from wattloom.llm.tiles import tiles


def routed(spark, lists, block):
    """Tiles of documents with these tokens; all that share any are one cluster."""
    first = spark.createDataFrame(list(lists.items()), "ref long, first array<long>").repartition(3)
    holders = {}
    for ref, tokens in lists.items():
        for token in tokens:
            holders.setdefault(token, []).append(ref)
    cluster = {ref: ref for ref in lists}

    def top(ref):
        while cluster[ref] != ref:
            cluster[ref] = ref = cluster[cluster[ref]]
        return ref

    for own in holders.values():
        for ref in own[1:]:
            cluster[max(top(ref), top(own[0]))] = min(top(ref), top(own[0]))
    # A document that shares no token is in no cluster.
    shared = {ref for own in holders.values() if len(own) > 1 for ref in own}
    clusters = spark.createDataFrame([(ref, top(ref)) for ref in shared], "ref long, cluster long")
    return [r.asDict() for r in tiles(clusters, first, block).collect()], holders


def meetings(rows):
    """How often each two documents meet, by the rule of the sides."""
    by_tile = {}
    for r in rows:
        by_tile.setdefault((r["i"], r["j"]), ([], []))[r["side"]].append(r["ref"])
    count = {}
    for (i, j), (left, right) in by_tile.items():
        met = combinations(sorted(left), 2) if i == j else ((a, b) for a in left for b in right)
        for a, b in met:
            pair = (min(a, b), max(a, b))
            count[pair] = count.get(pair, 0) + 1
    return count


def assert_whole(rows, holders):
    assert len({(r["ref"], r["i"], r["j"]) for r in rows}) == len(rows)
    count = meetings(rows)
    assert set(count.values()) <= {1}
    assert all(p in count for own in holders.values() for p in combinations(sorted(own), 2))
    packs = {}
    for r in rows:
        assert packs.setdefault((r["i"], r["j"]), r["pack"]) == r["pack"]


@pytest.mark.parametrize("block", [3, 16, 1000])
def test_every_pair_of_a_common_token_meets_once(spark, block):
    draw = random.Random(block)
    lists = {}
    for ref in range(300):
        # Three families of near copies, passages shared at random, and a token of many.
        own = {1000 + 10 * (ref % 3) + draw.randrange(8) for _ in range(4)} if ref < 120 else set()
        own |= {draw.randrange(60) for _ in range(2)} | ({7777} if ref % 2 else set())
        lists[ref] = sorted(own)
    lists[900], lists[901] = [-5, -6], [-6]
    assert_whole(*routed(spark, lists, block))


def test_a_long_chain_costs_its_postings(spark):
    """One cluster of 4,000 documents, each with a token of the next, is not squared."""
    lists = {ref: [ref, ref + 1] for ref in range(4000)}
    rows, holders = routed(spark, lists, 64)
    assert_whole(rows, holders)
    postings = sum(len(tokens) for tokens in lists.values())
    assert len(rows) <= postings + len(lists)
    # Compared as whole blocks, each document would have gone to all 63 of them.
    assert len(rows) < 4000 * 63 / 20


def test_copies_in_a_chain_stay_together(spark):
    """Groups of copies, each chained to the next: rows follow documents, not pairs."""
    size, groups = 40, 50
    lists = {}
    for g in range(groups):
        for k in range(size):
            own = [10_000 + 100 * g + t for t in range(6) if t == 0 or (k + t) % 7]
            lists[g * size + k] = own + ([5 + g] if k == 0 else []) + ([4 + g] if k == 1 else [])
    rows, holders = routed(spark, lists, 64)
    assert_whole(rows, holders)
    assert len(rows) < 3 * len(lists)


def test_no_documents(spark):
    clusters = spark.createDataFrame([], "ref long, cluster long")
    lists = spark.createDataFrame([], "ref long, first array<long>")
    assert tiles(clusters, lists, 8).collect() == []
