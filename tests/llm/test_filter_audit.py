"""Filter audit against brute force over every order, with repeated ids, nulls and hot copies."""

import re
from itertools import permutations

from pyspark.sql import functions as F
from tests.llm.fixtures import awkward_texts, words

from wattloom.llm.filter_audit import COUNTERS, filter_audit, packed_outcomes, unpacked

LABELS = "doc_id long, quality int, toxic int"


def failed(text):
    text = text or ""
    own = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(own) < 50,
        "B": 100 * len(set(own)) < 65 * len(own),
        "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        "D": bool(re.search("[#$%&*|]", text)),
    }


def by_hand(rows, labels):
    """Every order applied to every document of each part, left to right."""
    smaller = lambda k, t: any(o is not None and k is not None and o < k and (u or "") == (t or "") for o, u, _ in rows)
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    docs = [(k, p or "", {**failed(t), "E": smaller(k, t)}) for k, t, p in rows]
    found, removals = {}, {}
    for order in map("".join, permutations("ABCDE")):
        for part in {p for _, p, _ in docs}:
            left = own = [d for d in docs if d[1] == part]
            for step, letter in enumerate(order, start=1):
                gone = [d for d in left if d[2][letter]]
                stay = [d for d in left if not d[2][letter]]
                found[part, order, step] = (
                    len(stay),
                    len(gone),
                    sum(d[2][letter] for d in own) - len(gone),
                    sum(d[2][letter] and sum(d[2].values()) == 1 for d in own),
                    sum(d[0] in good for d in gone),
                    sum(d[0] in toxic for d in gone),
                )
                removals[part, letter] = removals.get((part, letter), 0) + len(gone)
                left = stay
    return {k: (*v, removals[k[0], k[1][k[2] - 1]]) for k, v in found.items()}


def audit(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {"mask": F.lit("clash"), "n": F.lit(1), "good": F.lit(None).cast("int"), "part": F.lit("x")}
    )
    got = filter_audit(docs, spark.createDataFrame(labels, LABELS).withColumn("text", F.lit("x"))).collect()
    assert len(got) == len({(r["part"], r["filter_order"], r["step"]) for r in got})
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in got}


def test_every_order_by_hand(spark):
    texts = awkward_texts() + [" ".join(words(i, 60, 10**6)) for i in range(12)]
    texts += ["A b| c", "A b| c", " ".join(words(3, 80, 9)), "LOUD " * 70, " ".join(words(2, 60, 10**6)) + " $"]
    rows = [(i, t, [None, "", "s", "src0"][i % 4]) for i, t in enumerate(texts)]
    # Copies across parts and within one, a hot text, repeated ids, rows without an id.
    rows += [(100 + i, texts[12], "s" if i % 3 else "t") for i in range(40)]
    rows += [(15, texts[15], "src0"), (15, texts[15], "src0"), (None, texts[16], "s"), (None, texts[16], "s")]
    rows += [(None, "only unnamed", "s"), (None, "only unnamed", "s"), (-5, texts[17], "t"), (3, "", None)]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 130, 2)]
    labels += [(15, 0, 0), (15, 1, None), (None, 1, 1), (999, 1, 1), (101, None, 1)]
    assert audit(spark, rows, labels) == by_hand(rows, labels)


def test_empty_tables(spark):
    assert audit(spark, [], [(1, 1, 1)]) == {}
    got = audit(spark, [(1, None, None)], [])
    assert len(got) == 600 and got["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)


def test_sums_of_very_many_documents_keep_their_fields():
    many = (1 << 55) - 1
    total = many * packed_outcomes(31, True, True) + many * packed_outcomes(0, False, False)
    counters = unpacked(total)
    assert (counters[:, 0, COUNTERS.index("removed")] == many).all()
    assert (counters[:, 1:, COUNTERS.index("redundant")] == many).all()
    assert (counters[:, :, COUNTERS.index("kept")] == many).all()


def test_registered(spark, sf_dir):
    from wattloom.llm.queries import QUERIES

    rows = QUERIES["op13_filter_audit"](spark, sf_dir)
    sources = spark.read.parquet(f"{sf_dir}/documents.parquet").select("source").distinct().count()
    assert rows.count() == 600 * sources
