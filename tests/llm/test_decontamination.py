"""Benchmark windows against brute force over all windows."""

import random
import time
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm.fixtures import awkward_texts, documents, words
from tests.llm.test_tokens import rows_of

from wattloom.llm import decontamination
from wattloom.llm.decontamination import contaminated, least_run, most_shift, simhash
from wattloom.llm.queries import QUERIES
from wattloom.workspace import materialize


def shingles(w, size=5):
    n = max(1, len(w) - size + 1) if w else 0
    return [tuple(w[i : i + size]) for i in range(n)]


def split(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [x for x in text.lower().split(" ") if x]


def by_hand(rows, items):
    best = {}
    for item, item_text in items:
        iw = split(item_text)
        own = Counter(shingles(iw))
        if item is None or not iw:
            continue
        for k, text in rows:
            w = split(text)
            for i in range(len(w) - len(iw) + 1):
                window = Counter(shingles(w[i : i + len(iw)]))
                lesser = sum((own & window).values())
                greater = sum((own | window).values())
                if k is not None and 100 * lesser >= 80 * greater:
                    found = (lesser / greater, -i, len(iw))
                    best[k, item] = max(best.get((k, item), (0, 0, 0)), found)
    return sorted((*key, -i, m, s) for key, (s, i, m) in best.items())


def spoiled(seed, base, edits):
    draw, own = random.Random(seed), list(base)
    for _ in range(edits):
        at, kind = draw.randrange(len(own)), draw.randrange(3)
        if kind == 0:
            own[at] = f"e{seed}"
        elif kind == 1:
            own.insert(at, f"i{seed}")
        else:
            del own[at]
    return own


def test_query_equals_brute_force(spark, sf_dir):
    import duckdb

    items = duckdb.connect().execute(f"SELECT * FROM '{sf_dir}/benchmark.parquet'").fetchall()
    got = sorted(map(tuple, QUERIES["op6_decontamination"](spark, sf_dir).collect()))
    rows = rows_of(sf_dir)
    assert got == sorted(by_hand(rows, items) + whole_by_hand(rows, items))


def test_edited_passages_at_any_place(spark):
    items = [(i, " ".join(words(900 + i, n, 3000))) for i, n in enumerate((6, 9, 15, 22, 34, 50, 80, 120))]
    items += [(20, "one two three"), (21, "solo"), (None, "null id item text here now"), (22, ""), (23, None)]
    items += [(24, "a b a b a b a b a b a b"), (25, items[3][1].upper())]
    texts = []
    for i in range(8):
        base = items[i][1].split()
        for e in range(5):
            left, right = words(i * 7 + e, e * 3 + i), words(i * 11 + e, 9)
            texts.append(" ".join(left + spoiled(10 * i + e, base, e) + right))
    texts += ["x one two three y", "one two", "solo", "b a b a b a b a b a b a b a", *awkward_texts()]
    texts += [" ".join(words(3, 40) + spoiled(99, items[7][1].split(), 1))]
    rows = list(enumerate(texts)) + [(None, items[4][1]), (2, items[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("m", F.lit("clash"))
    got = sorted(map(tuple, contaminated(df, bench.union(bench.limit(3))).collect()))
    want = by_hand([r for r in rows if r[0] != 2] , items)
    # Rows that share an id count together.
    both = by_hand([("a", texts[2]), ("b", items[5][1])], items)
    assert [r for r in got if r[0] != 2] == want
    assert {r[1] for r in got if r[0] == 2} == {r[1] for r in both}


@pytest.mark.parametrize("size", [40, 60, 100])
def test_passages_whose_parts_changed_places(spark, size):
    base = words(700 + size, size, 10**6)
    third = size // 3
    texts = [base[size // 2 :] + base[: size // 2], base[-third:] + base[:-third]]
    if size == 100:
        texts.append(base[:20] + base[60:] + base[20:60])
    rows = [(i, " ".join(words(i, 13 * i) + t + words(50 + i, 9))) for i, t in enumerate(texts)]
    rows.append((9, " ".join(base[size // 2 :])))
    bench = spark.createDataFrame([(1, " ".join(base))], "item_id long, text string")
    got = sorted(map(tuple, contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()))
    assert got == by_hand(rows, [(1, " ".join(base))])
    assert [r[:3] for r in got] == [(i, 1, 13 * i) for i in range(len(texts))]


def whole_by_hand(rows, items):
    """Documents of fewer words than the item, as one window."""
    found = []
    for item, item_text in items:
        iw = split(item_text)
        own = Counter(shingles(iw))
        for k, text in rows:
            w = split(text)
            if not 0 < len(w) < len(iw) or 5 * len(w) < 3 * len(iw):
                continue
            has = Counter(shingles(w))
            lesser, greater = sum((own & has).values()), sum((own | has).values())
            if 100 * lesser >= 80 * greater:
                found.append((k, item, 0, len(w), lesser / greater))
    return sorted(found)


def test_documents_shorter_than_an_item(spark):
    items = [(n, " ".join(words(300 + n, n, 10**6))) for n in (4, 6, 15, 39, 59)]
    rows = []
    for n, text in items:
        w = text.split()
        cuts = [w[:-1], w[1:], w[: n // 2] + w[n // 2 + 1 :], w[n // 2 :] + w[: n // 2 - 1]]
        cuts += [w[: n - k] for k in (2, 3, 7, 8, 11, 12) if k < n] + [w[: n // 2 - 1] + ["x"] + w[n // 2 + 1 :]]
        rows += [(1000 * n + i, " ".join(c)) for i, c in enumerate(cuts)]
    rows += [(1, ""), (2, "x"), (3, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()))
    assert got == sorted(by_hand(rows, items) + whole_by_hand(rows, items))
    assert {(15000, 15), (39000, 39), (59000, 59), (59002, 59)} <= {r[:2] for r in got}


def test_empty_tables(spark):
    docs = documents(spark, ["a b c d e f"])
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert contaminated(documents(spark, []), bench).count() == 0
    assert contaminated(docs, bench.limit(0)).count() == 0
    assert contaminated(docs, bench).count() == 1


@pytest.mark.parametrize("percent", [60, 80, 95])
def test_bounds_on_runs_hold(percent):
    for s in range(1, 200):
        differ = s - -(-2 * percent * s // (100 + percent))
        # As many common shingles as must be, spread as evenly as can be.
        assert least_run(s, percent) >= 1
        assert (differ + 1) * least_run(s, percent) - differ <= s
        assert most_shift(s, percent) == differ


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=9))
def test_simhash_is_the_majority_of_bits(spark, values):
    got = spark.createDataFrame([(values,)], "h array<long>").select(simhash(F.col("h"))).first()[0]
    want = sum(
        1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values)
    )
    assert got % (1 << 64) == want


def sliding(w, item):
    """Best window of the item's length, the overlap kept up word by word."""
    own, m = Counter(shingles(item)), len(item)
    grams = shingles(w)
    has, lesser, best = Counter(), 0, (0.0, 0)
    for i, g in enumerate(grams):
        has[g] += 1
        lesser += has[g] <= own[g]
        start = i - (m - 4) + 1
        if start > 0:
            old = grams[start - 1]
            lesser -= has[old] <= own[old]
            has[old] -= 1
        if start >= 0:
            s = lesser / (2 * (m - 4) - lesser)
            best = max(best, (s, -start))
    return best[0], -best[1]


def test_a_very_long_item_in_a_longer_document(spark):
    item = words(1, 5_000, 3_000)
    copy = spoiled(4, item, 60)
    text = words(2, 7_000, 3_000) + copy + words(3, 8_000, 3_000)
    rows = [(1, " ".join(text)), (2, " ".join(words(9, 20_000, 3_000)))]
    bench = spark.createDataFrame([(5, " ".join(item)), (6, "one two three four five")], "item_id long, text string")
    began = time.monotonic()
    got = [tuple(r) for r in contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()]
    assert time.monotonic() - began < 120
    similarity, start = sliding(text, item)
    assert got == [(1, 5, start, 5_000, similarity)]


def test_repeated_shingles_of_windows_and_items(spark):
    draw = random.Random(3)
    items, rows = [], []
    for i in range(12):
        part = words(40 + i, 4, 30)
        item = part * draw.randrange(2, 7) + words(60 + i, draw.randrange(0, 9), 50)
        items.append((i, " ".join(item)))
        rows.append((i, " ".join(words(i, 5, 50) + part * draw.randrange(1, 9) + item[8:] + words(i + 9, 5, 50))))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()))
    assert got == sorted(by_hand(rows, items) + whole_by_hand(rows, items))


def taken_apart(plan):
    """What each row of an exploded array keeps besides its entry, by node of the plan."""
    own = [plan.requiredChildOutput().mkString(" ")] if plan.getClass().getSimpleName() == "Generate" else []
    children = plan.children()
    return own + [x for i in range(children.size()) for x in taken_apart(children.apply(i))]


def test_no_row_of_a_shingle_or_window_holds_the_text(spark, monkeypatch):
    plans = []

    def stored(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan())
        return materialize(df, label)

    monkeypatch.setattr(decontamination, "materialize", stored)
    item = " ".join(f"w{i}" for i in range(40))
    text = " ".join([*(f"x{i}" for i in range(30_000)), item, *(f"y{i}" for i in range(30_000))])
    docs = spark.createDataFrame([(1, text), (2, None), (3, " "), (4, "few words")], "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (8, "few words")], "item_id long, text string")
    got = sorted(map(tuple, decontamination.contaminated(docs, items).collect()))
    assert got == [(1, 7, 30_000, 40, 1.0), (4, 8, 0, 2, 1.0)]
    kept = [x for plan in plans for x in taken_apart(plan)]
    assert kept and not [x for x in kept if "words" in x or "text" in x]
    # Nor is a text split again to test what its words give.
    assert not [str(plan) for plan in plans if " Filter " in str(plan) and "size(transform" in str(plan)]
