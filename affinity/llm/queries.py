"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm import (
    divergence,
    embed_join,
    html_extract,
    importance,
    langid,
    mixing,
    packing,
    quality,
    simhash,
    substring,
    topk,
    toxicity,
    warc_zip,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(_table(spark, sf_dir, "documents"), shingle_words=3, max_bits=2)
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op2_epsilon_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_join.embedding_components(_table(spark, sf_dir, "embeddings"), threshold=0.95)


def op3_warc_zip_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc_zip.write_archives(_table(spark, sf_dir, "pages"), min_revisit_bytes=1000)
    found = warc_zip.read_archives(spark, manifest, payloads=False)
    return found.select(
        F.col("record_id").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


def op4_bigru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_count_min_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.repeated_windows_removed(_table(spark, sf_dir, "documents"), window=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20, scale=64)


def op7_bitmask_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op8_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pack(_table(spark, sf_dir, "documents"), length=1024)
    return found.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op9_boosted_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", "n_chars")


def op10_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sources of equal shares cannot be sharpened: they stay as they are, with a warning
    found = mixing.mix(_table(spark, sf_dir, "documents"), target_entropy=0.98, max_repeats=4.0, on_conflict="nearest")
    return found.select(
        "doc_id",
        "source",
        F.col("__tokens").alias("n_tokens"),
        F.col("__copy").alias("copy"),
        F.col("__block").alias("block"),
        F.col("__position").alias("position"),
    )


def op11_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_crc_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = importance.resample(docs, target, percent=25, min_words=20, ngrams=2, buckets=10_000, seed=7)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"), min_docs=30, top_terms=50)


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_epsilon_grid_join": op2_epsilon_grid_join,
    "op3_warc_zip_reader": op3_warc_zip_reader,
    "op4_bigru_toxicity": op4_bigru_toxicity,
    "op5_count_min_substring_dedup": op5_count_min_substring_dedup,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_bitmask_language_id": op7_bitmask_language_id,
    "op8_cost_balanced_packing": op8_cost_balanced_packing,
    "op9_boosted_html_extraction": op9_boosted_html_extraction,
    "op10_temperature_mixing": op10_temperature_mixing,
    "op11_fourier_quality": op11_fourier_quality,
    "op12_crc_importance_resampling": op12_crc_importance_resampling,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE: dict[str, str] = {
    "op2_epsilon_grid_join": """
        WITH RECURSIVE v AS (
            SELECT vec_id, list_transform(embedding, lambda c: c::DOUBLE) AS x FROM embeddings
        ), u AS (
            SELECT vec_id, x, sqrt(list_sum(list_transform(x, lambda c: c * c))) AS n FROM v
            WHERE x IS NOT NULL AND len(list_filter(x, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
              AND len(list_filter(x, lambda c: c <> 0)) > 0
        ), l AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
            WHERE list_inner_product(a.x, b.x) / (a.n * b.n) >= 0.95
        ), r(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
        SELECT v.vec_id, coalesce(k.n, 0)::BIGINT AS n_links, c.m AS component_id, v.vec_id = c.m AS kept
        FROM v JOIN (SELECT a, min(b) AS m FROM r GROUP BY a) c ON c.a = v.vec_id
        LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) k ON k.a = v.vec_id
    """,
    "op3_warc_zip_reader": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS b FROM pages
        ), d AS (
            SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS payload_digest FROM p
        ), t AS (
            SELECT *, CASE WHEN payload_bytes >= 1000
                THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS top FROM d
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> top THEN top END AS refers_to
        FROM t
    """,
    "op5_count_min_substring_dedup": """
        WITH w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
        ), s AS (
            SELECT doc_id, unnest(range(1, len(words) - 18)) AS p, words FROM w WHERE len(words) >= 20
        ), h AS (
            SELECT doc_id, p, list_aggregate(words[p : p + 19], 'string_agg', ' ') AS k FROM s
        ), r AS (
            SELECT doc_id, p FROM h QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1
        ), g AS (
            SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS i FROM r
        ), x AS (
            SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w
        ), y AS (
            SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) AS kept, count(*) AS n_kept
            FROM x ANTI JOIN g ON g.doc_id = x.doc_id AND g.i = x.i GROUP BY x.doc_id
        )
        SELECT w.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n_kept, 0))::BIGINT AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM w LEFT JOIN y ON y.doc_id = w.doc_id
    """,
    "op6_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda c: floor(64 * c::DOUBLE)) AS x FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
        ), s AS (
            SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.x, b.x)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE a.vec_id % 20 = 0
        )
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
               vec_id, score FROM s QUALIFY rank <= 20
    """,
    "op12_crc_importance_resampling": """
        WITH RECURSIVE poly AS (
            SELECT i, i AS c, 0 AS k FROM range(256) r(i)
            UNION ALL
            SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM poly WHERE k < 8
        ), crc_table AS (
            SELECT list(c ORDER BY i) AS t FROM poly WHERE k = 8
        ), texts AS (
            SELECT row_number() OVER () AS r, doc_id, text, 's' AS side FROM documents
            UNION ALL SELECT row_number() OVER (), NULL, text, 't' FROM benchmark
        ), w AS (
            SELECT r, doc_id, side, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM texts
        ), f AS (
            SELECT side, r, unnest(list_concat(words, list_transform(range(1, len(words)),
                lambda i: words[i] || ' ' || words[i + 1]))) AS feature FROM w
        ), bytes AS (
            SELECT feature, list_transform(range(1, octet_length(encode(feature)) + 1),
                lambda i: ('0x' || substr(hex(encode(feature)), (2 * i - 1)::INTEGER, 2))::BIGINT) AS b
            FROM (SELECT DISTINCT feature FROM f)
        ), crc AS (
            SELECT feature, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
                lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) % 10000 AS bucket FROM bytes, crc_table
        ), n AS (
            SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t
            FROM f JOIN crc USING (feature) GROUP BY bucket
        ), gain AS (
            SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS g FROM n
        ), per_doc AS (
            SELECT r, count(*) AS n_features, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight
            FROM f JOIN crc USING (feature) JOIN gain USING (bucket) WHERE side = 's' GROUP BY r
        ), scored AS (
            SELECT w.r, doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('7:' || doc_id), 8))::BIGINT + 0.5::DOUBLE)
                       / 4294967296::DOUBLE)))::BIGINT AS score
            FROM w LEFT JOIN per_doc USING (r) WHERE side = 's'
        ), ranked AS (
            SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_words >= 20
        )
        SELECT doc_id, n_features::BIGINT AS n_features, weight, score, rank
        FROM scored LEFT JOIN (SELECT r, rank FROM ranked WHERE rank <= 25 * n // 100) USING (r)
    """,
    "op13_source_divergence": """
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words FROM documents
        ), t AS (
            SELECT r, lang, source, unnest(words) AS term FROM d
        ), kept AS (
            SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30
        ), v AS (
            SELECT lang, count(*) AS terms, sum(n) AS total FROM kept GROUP BY lang
        ), g AS (
            SELECT DISTINCT lang, source FROM d
        ), c AS (
            SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL
        ), full_counts AS (
            SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, kept.n AS n_lang,
                   sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
            FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
        ), p AS (
            SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)::HUGEINT) // (f.total + 5 * terms) AS p,
                   1 + (1000000000 * (n_lang + 5)::HUGEINT) // (v.total + 5 * terms) AS q
            FROM full_counts f JOIN v USING (lang)
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
            UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM found
        )
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
        WHERE part = 'pair' OR rank <= 50
    """,
}
