"""URL filter and top-k search against brute force."""

import math

import duckdb
import pytest
from check import TABLES, compare
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from wattloom.llm import topk
from wattloom.llm.queries import ORACLE_SQL, QUERIES, URL_RULES
from wattloom.llm.topk import is_usable, quantized, top_k
from wattloom.llm.url_filter import Rule, UrlTrie, judge_urls


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    verdict = compare(spark, con, sf_dir, name, ORACLE_SQL[name])
    assert verdict.startswith("ok") and "types" not in verdict, verdict


def by_hand(host, path, rules):
    best = (None, None)
    size = (-1, -1)
    for verdict, rule_host, rule_path in rules:
        fits = host == rule_host or host.endswith("." + rule_host)
        own = (rule_host.count("."), len(rule_path))
        if fits and path.startswith(rule_path) and own >= size:
            best, size = (rule_host + rule_path, verdict), own
    return best


def test_trie_equals_brute_force():
    rules = URL_RULES + [
        Rule("block", "a.org", ""),
        Rule("allow", "a.org", "/e"),
        Rule("block", "a.org", "/en/x"),
        Rule("allow", "a.org", "/en/xy/"),
        Rule("block", "b.a.org", "/"),
    ]
    hosts = ["", "com", ".com", "com.", "example.com", "www.example.com", "x.www.example.com"]
    hosts += ["xexample.com", "a.net", "net", "a.org", "b.a.org", "c.b.a.org", "org"]
    paths = ["", "/", "/e", "/en", "/en/", "/en/x", "/en/xy/z", "/es/", "//en/", "/fr/q", "en/"]
    trie = UrlTrie(rules)
    for host in hosts:
        for path in paths:
            assert trie.match(host, path) == by_hand(host, path, rules), (host, path)


def test_urls_of_every_shape(spark):
    urls = [
        (1, "https://WWW.Example.com/en/1?x=/y#z"),
        (2, None),
        (3, ""),
        (4, "no scheme/en/"),
        (5, "http://example.com"),
        (6, "http://a://b/c"),
        (7, "x\ny://ÄB.Com?q"),
        (8, "http://" + "a." * 5000 + "net/fr/" + "x" * 20000),
        (8, "http://example.com/en/"),
        (None, "http://example.com/en/"),
    ]
    df = spark.createDataFrame(urls, "page_id long, url string").withColumn("rule", F.lit(0))
    got = [tuple(r) for r in judge_urls(df, URL_RULES).collect()]
    assert got[0] == (1, "www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[1:4] == [(i, "", "", None, "allow") for i in (2, 3, 4)]
    assert got[4] == (5, "example.com", "", None, "allow")
    assert got[5] == (6, "a:", "//b/c", None, "allow")
    assert got[6] == (7, "Äb.com", "", None, "allow")
    assert got[7][3:] == ("net/fr/", "block")
    assert got[8] == (8, "example.com", "/en/", "example.com/en/", "block")
    assert got[9][0] is None
    assert judge_urls(df.limit(0), URL_RULES).count() == 0


def search_by_hand(rows, queries, k):
    out = []
    for q, v in queries:
        found = [
            (-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q
        ]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


@pytest.mark.parametrize("scale", [1, 10**6])
def test_top_k_equals_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "TILE_VECTORS", 3)
    monkeypatch.setattr(topk, "SHARD_VECTORS", 5)
    monkeypatch.setattr(topk, "FAN_IN", 2)
    rows = [(i, [scale * ((i * 7 + d * 3) % 5 - 2) for d in range(4)]) for i in range(60)]
    rows += [(100 + i, [scale, 0, scale, 0]) for i in range(30)] + [(200, [1]), (201, []), (7, [1, 1, 1, 1])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>").repartition(3)
    bad = spark.createDataFrame(
        [(None, [1]), (300, None), (320, [1, None])], "vec_id long, vector array<long>"
    )
    df = df.union(bad).withColumn("score", F.lit("clash"))
    queries = [(i, v) for i, v in rows if i % 20 == 0]
    got = top_k(df.where("vec_id % 20 = 0"), df, k=6)
    assert sorted(map(tuple, got.collect())) == search_by_hand(rows, queries, 6)


def test_top_k_sends_rows_once_per_block(spark, monkeypatch):
    monkeypatch.setattr(topk, "TILE_VECTORS", 2)
    monkeypatch.setattr(topk, "SHARD_VECTORS", 3)
    rows = [(i, [(i * 7 + d * 3) % 11 - 5 for d in range(4)]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>").repartition(4)
    sent, kind = [], type(df)
    plain = kind.mapInArrow

    def counted(df, run, schema, *rest, **named):
        if schema == topk._LISTS:
            sent.append(df.count())
        return plain(df, run, schema, *rest, **named)

    monkeypatch.setattr(kind, "mapInArrow", counted)
    queries = [(i, v) for i, v in rows if i % 20 == 0]
    got = top_k(df.where("vec_id % 20 = 0"), df, k=4)
    assert sorted(map(tuple, got.collect())) == search_by_hand(rows, queries, 4)
    # 15 tiles or more and 200 shards or more: each once, not each pair.
    assert 215 <= sent[0] < 300


@pytest.mark.parametrize("scale", [1, 10**6, 2 * 10**8])
def test_top_k_of_many_blocks(spark, monkeypatch, scale):
    for name, value in {"TILE_VECTORS": 3, "SHARD_VECTORS": 50, "FAN_IN": 2}.items():
        monkeypatch.setattr(topk, name, value)
    monkeypatch.setattr(topk, "GROUP_QUERIES", 8, raising=False)
    monkeypatch.setattr(topk, "BLOCK_SCORES", 800, raising=False)
    # Most vectors are equal, so ties fill whole shards; ids repeat, and lengths differ.
    rows = [(i * 13 % 601, [scale, -scale, scale]) for i in range(400)]
    rows += [(i * 7 % 300, [scale * ((i * 5 + d * 3) % 9 - 4) for d in range(i % 4 + 1)]) for i in range(150)]
    queries = [(i, v) for i, v in rows if i % 25 == 0]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>").repartition(5)
    wanted = spark.createDataFrame(queries, "vec_id long, vector array<long>").repartition(3)
    got = top_k(wanted, df, k=7)
    assert sorted(map(tuple, got.collect())) == search_by_hand(rows, queries, 7)


def test_top_k_of_too_great_scores_fails(spark):
    df = spark.createDataFrame([(0, [1 << 40, 5]), (1, [1 << 40, 1])], "vec_id long, vector array<long>")
    with pytest.raises(PythonException, match="64-bit"):
        top_k(df, df).collect()


def test_top_k_with_few_or_no_vectors(spark):
    df = spark.createDataFrame([(0, [1, 2]), (1, [3, 4])], "vec_id long, vector array<long>")
    assert [tuple(r) for r in top_k(df.where("vec_id = 0"), df).collect()] == [(0, 1, 1, 11)]
    assert top_k(df.limit(0), df).count() == 0
    assert top_k(df, df.limit(0)).count() == 0


def test_quantized_and_usable(spark):
    rows = [(1, [0.5, -0.01]), (2, None), (3, [1.0, None]), (4, [math.nan]), (5, [math.inf]), (6, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    kept = df.where(is_usable(F.col("embedding"))).select("vec_id", quantized(F.col("embedding")))
    assert sorted(map(tuple, kept.collect())) == [(1, [32, -1]), (6, [])]


def test_queries_are_registered():
    assert {"op2_url_filter", "op8_top_k"} <= set(QUERIES)
