"""One query for each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetspark.llm import (
    ann, kdtree, licenses, lm, mixing, near_dedup, packing, phrases, pii, prefix_trie, quality, sharding, suffixes,
)
from fleetspark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


SHARD_BYTES = 16 << 20


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


ORACLE["op1_sharding"] = f"""
WITH h AS (
    SELECT doc_id, strlen(coalesce(text, '')) AS bytes,
        ('0x' || left(md5(coalesce(doc_id::VARCHAR, '') || chr(31) || coalesce(text, '')), 15))::BIGINT AS hash
    FROM documents
), p AS (
    SELECT doc_id, bytes, d AS depth, hash >> (60 - d) AS prefix FROM h, range(0, 61) t(d)
), n AS (
    SELECT depth, prefix, sum(bytes)::BIGINT AS shard_bytes FROM p GROUP BY depth, prefix
), r AS (
    SELECT p.*, shard_bytes, row_number() OVER (PARTITION BY doc_id ORDER BY p.depth) AS k
    FROM p JOIN n ON p.depth = n.depth AND p.prefix = n.prefix
    WHERE shard_bytes <= {SHARD_BYTES} OR p.depth = 60
)
SELECT doc_id, bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth::INT, '0') END AS shard,
    depth::INTEGER AS depth, 0::BIGINT AS page, shard_bytes
FROM r WHERE k = 1
"""


@query
def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows.where("vec_id % 100 = 0"))


@query
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query
def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"))


@query
def op7_kdtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return kdtree.top_k(rows, rows.where("vec_id % 100 = 0"))


ORACLE["op7_kdtree_topk"] = """
WITH v AS (
    SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
), s AS (
    SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e)::BIGINT AS score
    FROM v q JOIN v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id
), r AS (
    SELECT query_id, vec_id, score,
        row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
    FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# Shares of the mixed corpus; the clean documents set its size.
MIX_WEIGHTS = {"clean": 0.95, "low": 0.04, "toxic": 0.01}


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), MIX_WEIGHTS)


@query
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), 85, 100).drop("class")


ORACLE["op10_minhash_near_dedup"] = """
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\v\f\r]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
    FROM words
), items AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS c
    FROM items a JOIN items b ON a.item = b.item AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT x, y FROM shared WHERE 100 * c >= 85 * (nx + ny - c)
    UNION SELECT y, x FROM shared WHERE 100 * c >= 85 * (nx + ny - c)
), reach AS (
    SELECT x, y FROM links
    UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), smallest AS (
    SELECT x, min(y) AS m FROM reach GROUP BY x
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
    doc_id = least(doc_id, coalesce(m, doc_id)) AS kept
FROM sets LEFT JOIN smallest ON x = doc_id
"""


@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


ORACLE["op11_phrase_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, w FROM (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces) WHERE len(w) > 0
), starts AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM starts, range(1, 6) t(k) WHERE i + k - 1 <= len(w)
    GROUP BY ALL HAVING count(*) >= 100
), totals AS (
    SELECT lang, count(*) AS n FROM starts GROUP BY lang
), parts AS (
    SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM grams
), inside AS (
    SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS around
    FROM parts, range(2, 5) a(m), range(1, 5) b(i)
    WHERE m < k AND i + m - 1 <= k GROUP BY ALL
), cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, l.f AS l, r.f AS r, n, l.k AS cut,
        ((1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM parts c JOIN totals USING (lang)
    LEFT JOIN inside x ON x.lang = c.lang AND x.phrase = c.phrase
    JOIN range(1, 5) t(j) ON j < c.k
    JOIN grams l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:j], ' ')
    JOIN grams r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1:], ' ')
    WHERE c.k > 1 AND (around IS NULL OR 100 * around < 100 * c.f)
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
        phrase, a, l, r, n, score FROM lowest
)
SELECT * FROM ranked WHERE rank <= 2000
"""


@query
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


ORACLE["op13_prefix_trie"] = r"""
WITH turns AS (
    SELECT conv_id, coalesce(text, '') AS x, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), words AS (
    SELECT id, any_value(len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))) AS words FROM turns GROUP BY id
), convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, list(id ORDER BY pos) AS own,
        xor(list_reduce([4294967295] || [ord(c)::BIGINT FOR c IN string_split(conv_id::VARCHAR, '')], lambda crc, b:
            list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z:
                CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % 4 AS h
    FROM turns GROUP BY conv_id
), rebuilt AS (
    SELECT c.conv_id, array_to_string(list_concat(coalesce(b.own, [])[1:c.h], c.own[c.h + 1:]), '') AS key
    FROM convs c LEFT JOIN convs b ON b.conv_id = c.base
), members AS (
    SELECT conv_id, d AS depth, substr(key, 1, 32 * d) AS path, length(key) = 32 * d AS whole
    FROM (SELECT conv_id, key, unnest(range(0, length(key) // 32 + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE whole), '')) AS ends_sha256
    FROM members GROUP BY path, depth
), linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id, coalesce(k.children, 0) AS n_children, coalesce(w.words, 0) AS words
    FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = substr(n.path, 1, 32 * (n.depth - 1))
    LEFT JOIN (SELECT substr(path, 1, 32 * (depth - 1)) AS up, depth - 1 AS d, count(*) AS children
        FROM nodes WHERE depth > 0 GROUP BY ALL) k ON k.up = n.path AND k.d = n.depth
    LEFT JOIN words w ON w.id = right(n.path, 32)
), subtrees AS (
    SELECT substr(path, 1, 32 * d) AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
        sum((n_convs - 1) * words)::BIGINT AS saved_tokens
    FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM linked) GROUP BY 1
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM linked JOIN subtrees USING (path)
"""
