"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm import prepare
from wattloom.llm.decontamination import contaminated
from wattloom.llm.filter_audit import filter_audit
from wattloom.llm.jaccard_join import near_duplicates
from wattloom.llm.language_id import language_ids
from wattloom.llm.merkle import folded, leaf_hash, merkle_manifest, siblings
from wattloom.llm.packing import pack_documents
from wattloom.llm.secret_scan import KINDS, count_of, find_secrets, written_spans
from wattloom.llm.substring_dedup import remove_repeats
from wattloom.llm.token_counts import token_counts
from wattloom.llm.token_files import read_token_files, write_token_files
from wattloom.llm.topk import is_usable, quantized, top_k
from wattloom.llm.toxicity import toxicity_scores
from wattloom.llm.url_filter import Rule, judge_urls
from wattloom.workspace import new_path

TOKEN_LIMIT = 512
LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
URL_RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    counts = token_counts(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allow or block every page by its URL."""
    return judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near-duplicate documents."""
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: counts and positions."""
    found = find_secrets(_table(spark, sf_dir, "documents"))
    counts = [count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in KINDS[:3]]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(written_spans(F.col("base")), 256).alias("base_sha256"),
        written_spans(F.col("spans")).alias("spans"),
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in documents."""
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that lie in repeated windows of 35 words."""
    found = remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best neighbours of every twentieth vector."""
    vectors = (
        _table(spark, sf_dir, "embeddings")
        .where(is_usable(F.col("embedding")))
        .select("vec_id", quantized(F.col("embedding")).alias("vector"))
    )
    return top_k(vectors.where(F.col("vec_id") % 20 == 0), vectors, k=20)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2,048 tokens."""
    return pack_documents(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        size=2048,
        end_id=1,
        with_ids=False,
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token-id files and read back."""
    folder = new_path(spark, "token-files")
    write_token_files(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder
    )
    return read_token_files(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and proofs of all documents; a fifth of them verified after tampering."""
    docs = _table(spark, sf_dir, "documents")
    leaf = leaf_hash(*[F.col(c) for c in LEAF_FIELDS])
    lowered = F.translate("text", _CAPITALS, _CAPITALS.lower())
    changed = leaf_hash(*[lowered if c == "text" else F.col(c) for c in LEAF_FIELDS])
    is_chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = merkle_manifest(docs, leaf, carry={"tampered": F.when(is_chosen, changed)})
    refolded = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        refolded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents."""
    return language_ids(_table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders, by source."""
    return filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_url_filter": op2_url_filter,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_toxicity": op4_toxicity,
    "op5_secret_scan": op5_secret_scan,
    "op6_decontamination": op6_decontamination,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_top_k": op8_top_k,
    "op9_packing": op9_packing,
    "op10_token_files": op10_token_files,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_language_id": op12_language_id,
    "op13_filter_audit": op13_filter_audit,
}

_SPACES = "'[\\x20\\t-\\r]+'"
_WORDS = f"list_filter(regexp_split_to_array({{0}}, {_SPACES}), lambda x: x <> '')"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _field_sql(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return f"sha256({' || '.join(_field_sql(text if c == 'text' else c) for c in LEAF_FIELDS)})"


# Unsigned crc32 of an id as text, a bit at a time.
_CRC32 = """xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, c: list_reduce(
        list_concat([xor(a, c)], list_transform(range(8), lambda i: 0::BIGINT)),
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


def _climb_sql(name: str, leaves: str) -> str:
    """Nodes ``tree, level, pos, node, n`` of all levels above ``leaves``."""
    return f"""{name} AS (
        SELECT tree, 0 AS level, pos, node, n FROM {leaves}
        UNION ALL
        SELECT tree, level + 1, pos // 16, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 15) // 16
        FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 16
    ), {name}_around AS (
        SELECT tree, level, pos, node, n,
               coalesce(string_agg(node, '') OVER (before ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
               coalesce(string_agg(node, '') OVER (before ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
        FROM {name} WINDOW before AS (PARTITION BY tree, level, pos // 16 ORDER BY pos)
    )"""


ORACLE_SQL = {
    "op11_merkle_manifest": f"""
        WITH RECURSIVE rows AS (
            SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf_sql("text")} AS leaf,
                   CASE WHEN {_CRC32} % 5 = 0
                        THEN {_leaf_sql(f"translate(text, '{_CAPITALS}', '{_CAPITALS.lower()}')")} END AS tampered
            FROM documents
        ), places AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                   count(*) OVER (PARTITION BY tree) AS n FROM rows
        ), leaves AS (
            SELECT tree, pos, leaf AS node, n FROM places
        ), {_climb_sql("nodes", "leaves")}, subroots AS (
            SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, node, count(*) OVER () AS n,
                   tree AS of FROM nodes WHERE n = 1
        ), {_climb_sql("tops", "subroots")}, root AS (
            SELECT node AS root FROM tops WHERE n = 1
        ), paths AS (
            SELECT tree, p.pos, level, l, r FROM places p JOIN nodes_around a USING (tree)
            WHERE a.n > 1 AND a.pos = p.pos // (16 ** level)::BIGINT
            UNION ALL
            SELECT s.of, p.pos, 100 + level, l, r
            FROM places p JOIN subroots s ON s.of = p.tree JOIN tops_around a ON a.n > 1
             AND a.pos = s.pos // (16 ** level)::BIGINT
        ), proofs AS (
            SELECT tree, pos, string_agg(l || r, '' ORDER BY level) AS proof,
                   list(l || '|' || r ORDER BY level) AS steps FROM paths GROUP BY tree, pos
        )
        SELECT doc_id, leaf, s.node AS subroot, root, sha256(coalesce(proof, '')) AS proof_sha256,
               list_reduce(list_concat([coalesce(tampered, leaf)], coalesce(steps, [])),
                           lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))) AS folded_root,
               folded_root = root AS verified
        FROM places JOIN subroots s ON s.of = places.tree CROSS JOIN root
             LEFT JOIN proofs ON proofs.tree = places.tree AND proofs.pos = places.pos
    """,
    "op13_filter_audit": f"""
        WITH flags AS (
            SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good,
                   bool_or(coalesce(toxic = 1, false)) AS toxic
            FROM labels GROUP BY doc_id
        ), d AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                   {_WORDS.format("coalesce(text, '')")} AS w,
                   min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
            FROM documents
        ), fails AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                   len(w) < 50 AS fa, 100 * len(list_distinct(w)) < 65 * len(w) AS fb,
                   100 * (length(t) - length(translate(t, '{_CAPITALS}', ''))) > 5 * length(t) AS fc,
                   regexp_matches(t, '[#$%&*|]') AS fd, coalesce(doc_id > least, false) AS fe
            FROM d LEFT JOIN flags USING (doc_id)
        ), masks AS (
            SELECT part, good, toxic, fa::INT + 2 * fb::INT + 4 * fc::INT + 8 * fd::INT + 16 * fe::INT AS mask,
                   count(*) AS n FROM fails GROUP BY ALL
        ), letters(letter, bit) AS (
            VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
        ), orders AS (
            SELECT p.letter || q.letter || r.letter || s.letter || t.letter AS filter_order
            FROM letters p, letters q, letters r, letters s, letters t
            WHERE p.bit | q.bit | r.bit | s.bit | t.bit = 31
        ), steps AS (
            SELECT filter_order, step, letter, bit,
                   (SELECT coalesce(sum(e.bit), 0) FROM letters e
                    WHERE strpos(filter_order, e.letter) < step)::INT AS earlier
            FROM orders, range(1, 6) AS s(step) JOIN letters ON letter = substr(filter_order, step, 1)
        ), counted AS (
            SELECT part, filter_order, step::INT AS step, letter,
                   coalesce(sum(n) FILTER (mask & (earlier | bit) = 0), 0)::BIGINT AS kept,
                   coalesce(sum(n) FILTER (mask & earlier = 0 AND mask & bit > 0), 0)::BIGINT AS removed,
                   coalesce(sum(n) FILTER (mask & earlier > 0 AND mask & bit > 0), 0)::BIGINT AS redundant,
                   coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
                   coalesce(sum(n) FILTER (mask & earlier = 0 AND mask & bit > 0 AND good), 0)::BIGINT
                       AS good_lost,
                   coalesce(sum(n) FILTER (mask & earlier = 0 AND mask & bit > 0 AND toxic), 0)::BIGINT
                       AS toxic_lost
            FROM masks, steps GROUP BY ALL
        )
        SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
        FROM counted
    """,
    "op3_jaccard_join": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
            FROM d, unnest(range(1, greatest(len(w) - 3, CASE WHEN len(w) > 0 THEN 2 ELSE 1 END)))
                 AS t(i)
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), links AS (
            SELECT x.doc_id AS a, y.doc_id AS b
            FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
                 JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
            GROUP BY x.doc_id, y.doc_id, nx.n, ny.n
            HAVING 100 * count(*) >= 80 * (nx.n + ny.n - count(*))
        ), reach AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION
            SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
        )
        SELECT documents.doc_id, coalesce(any_value(n.n), 0) AS n_shingles,
               min(reach.other) AS component_id,
               (SELECT count(*) FROM links WHERE links.a = documents.doc_id) AS n_links
        FROM documents JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id)
        GROUP BY documents.doc_id
    """,
    "op6_decontamination": f"""
        WITH d AS (
            SELECT doc_id, {_WORDS.format("lower(text)")} AS w FROM documents
        ), b AS (
            SELECT item_id, {_WORDS.format("lower(text)")} AS w FROM benchmark
        ), ds AS (
            SELECT doc_id, i - 1 AS p, array_to_string(w[i:i + 4], ' ') AS g
            FROM d, unnest(range(1, len(w) - 3)) AS t(i)
        ), bs AS (
            SELECT item_id, len(w) AS m, array_to_string(w[i:i + 4], ' ') AS g, count(*) AS c
            FROM b, unnest(range(1, len(w) - 3)) AS t(i) GROUP BY ALL
        ), pairs AS (
            SELECT DISTINCT ds.doc_id, bs.item_id, bs.m FROM ds JOIN bs USING (g)
        ), windows AS (
            SELECT pairs.*, start, least(len(w), m) AS held FROM pairs JOIN d USING (doc_id),
                   unnest(range(0, greatest(len(w) - m, 0) + 1)) AS t(start)
        ), counted AS (
            SELECT windows.doc_id, item_id, m, held, start, g, count(*) AS c
            FROM windows JOIN ds ON ds.doc_id = windows.doc_id AND p BETWEEN start AND start + held - 5
            GROUP BY ALL
        ), lesser AS (
            SELECT doc_id, item_id, counted.m, held, start, sum(least(counted.c, bs.c))::BIGINT AS n
            FROM counted JOIN bs USING (item_id, g) GROUP BY ALL
        ), alike AS (
            SELECT *, n / (held + m - 8 - n) AS similarity FROM lesser
            WHERE 100 * n >= 80 * (held + m - 8 - n)
        )
        SELECT doc_id, item_id, start, held AS n_words, similarity FROM alike
        QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
    """,
    "op7_substring_dedup": f"""
        WITH d AS (
            SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents
        ), windows AS (
            SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS k
            FROM d, unnest(range(1, len(w) - 33)) AS t(i)
        ), repeated AS (
            SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY k) > 1
        ), gone AS (
            SELECT DISTINCT doc_id, i + o AS p FROM repeated, unnest(range(0, 35)) AS t(o)
        ), positions AS (
            SELECT doc_id, w, list(p) AS ps FROM d LEFT JOIN gone USING (doc_id) GROUP BY ALL
        ), kept AS (
            SELECT doc_id, w, list_filter(
                list_transform(w, lambda x, i: CASE WHEN list_contains(ps, i) THEN '' ELSE x END),
                lambda x: x <> '') AS k FROM positions
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - len(k))::BIGINT AS n_removed,
               sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
    """,
    "op2_url_filter": """
        WITH split AS (
            SELECT page_id,
                   CASE WHEN contains(url, '://')
                        THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), parts AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM split
        ), rules(rule_host, rule_path, rule_verdict) AS (
            VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
                   ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'),
                   ('net', '/fr/', 'block')
        ), fits AS (
            SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                   arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
            FROM parts JOIN rules
              ON (host = rule_host OR ends_with(host, '.' || rule_host))
             AND starts_with(path, rule_path)
            GROUP BY page_id
        )
        SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
        FROM parts LEFT JOIN fits USING (page_id)
    """,
    "op8_top_k": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), products AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
            FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 20 = 0
        ), ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id
                                                ORDER BY score DESC, vec_id)::INTEGER AS rank,
                   vec_id, score
            FROM products
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
}
