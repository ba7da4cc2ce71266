"""One query for each operator, with production parameters over whole tables, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyroom.llm import alignment, embedding_dedup, html_text, mixing, packing, phrases, sharding, substring_dedup, text_dedup, topk, toxicity, urls, vector_packing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, table: str, sql: str | None = None):
    """Register a function of one table under `name`."""

    def register(make: Callable[[DataFrame], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return make(spark.read.parquet(f"{folder}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return make

    return register


WORDS = r"[^\x20\x09-\x0D]+"

REPEATS_SQL = rf"""
    WITH w AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS ws FROM documents
    ), places AS (
        SELECT r, unnest(ws) AS word, unnest(range(CAST(len(ws) AS BIGINT))) AS i FROM w
    ), windows AS (
        SELECT r, doc_id, unnest(range(CAST(len(ws) AS BIGINT) - 12)) AS i,
               unnest(list_transform(range(1, CAST(len(ws) AS BIGINT) - 11), lambda i: array_to_string(ws[i:i + 12], ' '))) AS words
        FROM w WHERE len(ws) >= 13
    ), judged AS (
        SELECT r, doc_id, i, min(doc_id) OVER (PARTITION BY words) AS first FROM windows
    ), gone AS (
        SELECT DISTINCT r, i + j AS i FROM judged, range(13) AS t(j) WHERE first < doc_id
    ), kept AS (
        SELECT p.r, array_to_string(list(p.word ORDER BY p.i), ' ') AS words, count(*) AS n
        FROM places p ANTI JOIN gone g ON p.r = g.r AND p.i = g.i GROUP BY p.r
    )
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(words, '')) AS kept_sha256
    FROM w LEFT JOIN kept ON w.r = kept.r
"""

NEAR_TEXTS_SQL = rf"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') AS ws
        FROM documents
    ), s AS (
        SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle
        FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, CAST(len(ws) AS BIGINT) - 3))) AS i FROM w WHERE len(ws) > 0)
    ), n AS (
        SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
    ), shared AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
        FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
    ), links AS (
        SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
        WHERE 100 * shared.n >= 75 * (a.n + b.n - shared.n)
    ), reached AS (
        SELECT DISTINCT x, x AS y FROM links
        UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y
    ), c AS (
        SELECT x, min(y) AS component_id FROM reached GROUP BY x
    )
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id,
           coalesce(component_id, w.doc_id) = w.doc_id AS kept
    FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.x = w.doc_id
"""

NEAR_VECTORS_SQL = """
    WITH RECURSIVE v AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), u AS (
        SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM v
    ), links AS (
        SELECT a.vec_id AS x, b.vec_id AS y
        FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
        WHERE a.size > 0 AND b.size > 0
          AND list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2])) >= 0.98 * a.size * b.size
    ), reached AS (
        SELECT DISTINCT x, x AS y FROM links
        UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y
    ), c AS (
        SELECT x, min(y) AS component_id FROM reached GROUP BY x
    ), n AS (
        SELECT x, count(*) AS n FROM links GROUP BY x
    )
    SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
           coalesce(component_id, vec_id) = vec_id AS kept
    FROM embeddings e LEFT JOIN n ON n.x = e.vec_id LEFT JOIN c ON c.x = e.vec_id
"""


@query("op4_minhash_hamming_join", "documents", NEAR_TEXTS_SQL)
def op4(docs: DataFrame) -> DataFrame:
    return text_dedup.near_texts(docs, 75)


TOPK_SQL = """
    WITH v AS (
        SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
        WHERE q.vec_id % 50 = 0
    ), r AS (
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s
    )
    SELECT * FROM r WHERE rank <= 5
"""


@query("op1_pq_near_vectors", "embeddings", NEAR_VECTORS_SQL)
def op1(vectors: DataFrame) -> DataFrame:
    return embedding_dedup.near_vectors(vectors, 0.98)


@query("op2_best_fit_packing", "documents")
def op2(docs: DataFrame) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


@query("op3_temperature_mixing", "documents")
def op3(docs: DataFrame) -> DataFrame:
    """Every source at least once, the smallest one at most four times as often as the largest."""
    return mixing.mixed_blocks(docs, target_entropy=0.98, repetition_limit=4.0)


@query("op5_threshold_topk", "embeddings", TOPK_SQL)
def op5(vectors: DataFrame) -> DataFrame:
    return topk.top_k(vectors, 5, 50)


@query("op6_template_removal", "pages")
def op6(pages: DataFrame) -> DataFrame:
    return html_text.extract_pages(pages)


@query("op7_hypergeometric_sharding", "documents")
def op7(docs: DataFrame) -> DataFrame:
    return sharding.shard_documents(docs, 24)


def op8(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity.score_documents(spark.read.parquet(f"{folder}/documents.parquet"), labels)


QUERIES["op8_subword_toxicity"] = op8

@query("op10_debruijn_repeats", "documents", REPEATS_SQL)
def op10(docs: DataFrame) -> DataFrame:
    return substring_dedup.count_removed(docs, 13)


URL_SQL = """
    WITH parts AS (
        SELECT page_id, url,
               CASE WHEN strpos(coalesce(url, ''), '://') > 0
                    THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest
        FROM pages
    ), split AS (
        SELECT page_id,
               translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path
        FROM parts
    ), ruled AS (
        SELECT *, CASE
            WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
            WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
            WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
            WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
            WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule
        FROM split
    )
    SELECT page_id, host, path, rule, CASE
        WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
        WHEN path LIKE '%/wp-admin/%' OR path LIKE '%/wp-login.php%' OR path LIKE '%/cgi-bin/%' OR path LIKE '%/login/%'
          OR path LIKE '%/logout/%' OR path LIKE '%/cart/%' OR (host || path) LIKE '%.exe' OR (host || path) LIKE '%.zip'
          OR (host || path) LIKE '%.iso' OR path LIKE '%//%//%' THEN 'block' ELSE 'allow' END AS verdict
    FROM ruled
"""


@query("op9_url_wildcards", "pages", URL_SQL)
def op9(pages: DataFrame) -> DataFrame:
    return urls.judge_urls(pages)


@query("op11_vector_packing", "documents")
def op11(docs: DataFrame) -> DataFrame:
    return vector_packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


#: The grammar of DuckDB's regular expressions is that of RE2; its 128-bit integers hold the products.
PHRASE_SQL = """
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents WHERE text IS NOT NULL
    ), lists AS (
        SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
    ), grams AS (
        SELECT lang, k, unnest(list_transform(generate_series(1, len(w) - k + 1), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
        FROM lists, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k
    ), f AS (
        SELECT lang, phrase, any_value(k) AS k, count(*) AS c FROM grams GROUP BY lang, phrase
    ), totals AS (
        SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
    ), chosen AS (
        SELECT lang, phrase, k, c AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND c >= 10
    ), cuts AS (
        SELECT lang, phrase, k, a, unnest(generate_series(1, k - 1)) AS cut, w FROM chosen
    ), scored AS (
        SELECT c.lang, c.phrase, c.k, c.a, c.cut, l.c AS l, r.c AS r,
               CAST((1000000::HUGEINT * c.a * c.a) // (l.c::HUGEINT * r.c) AS BIGINT) AS score
        FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.cut], ' ')
        JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')
    ), lowest AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
    ), longer AS (
        SELECT lang, array_to_string(w[s:s + 1], ' ') AS phrase, max(a) AS most
        FROM chosen, (SELECT unnest([1, 2]) AS s) WHERE k = 3 GROUP BY ALL
    ), ranked AS (
        SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, encode(c.phrase)) AS rank, c.phrase, a, l, r, score
        FROM lowest c LEFT JOIN longer g ON g.lang = c.lang AND g.phrase = c.phrase AND 100 * g.most >= 50 * c.a
        WHERE g.phrase IS NULL
    )
    SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query("op12_phrase_automata", "documents", PHRASE_SQL)
def op12(docs: DataFrame) -> DataFrame:
    return phrases.collocations(docs)

@query("op13_interval_alignment", "documents")
def op13(docs: DataFrame) -> DataFrame:
    return alignment.align_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
