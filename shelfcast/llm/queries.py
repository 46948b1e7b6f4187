"""Registered queries of this folder: thin, whole-table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    decontaminate, hard_negatives, jaccard_join, language, licenses, personal_data, pieces, resampling, sharding,
    substring_dedup, token_files, top_k, url_filter)
from shelfcast.session import shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "matched", "length", "first_token")


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.round(c, 6) for c in ("probability", "similarity")})


URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
             ("block", "com/de/"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"), URL_RULES)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(pieces.encode_and_decode(table(spark, sf_dir, "documents")))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, _ = sharding.into_shards(table(spark, sf_dir, "documents"), shared_path(spark, "slot-map"), 8)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}) \
        .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return language.identify(docs).select("doc.doc_id", "language", F.round("confidence", 6).alias("confidence"), "keep")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.digests(substring_dedup.remove_repeats(docs))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(table(spark, sf_dir, "documents"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digests(personal_data.personal_data(table(spark, sf_dir, "documents")))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), shifted)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_top_k": op2_top_k,
    "op3_license_scan": op3_license_scan,
    "op4_url_filter": op4_url_filter,
    "op5_token_files": op5_token_files,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_sharding": op7_sharding,
    "op8_language_id": op8_language_id,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_personal_data": op11_personal_data,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_hard_negatives": op13_hard_negatives,
}
_RULES_SQL = ", ".join(
    f"('{rule}', '{rule.split('/')[0]}', '/{rule.split('/', 1)[1]}', '{verdict}')" for verdict, rule in URL_RULES)

ORACLE: dict[str, str] = {
    "op2_top_k": """
        WITH usable AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10""",
    "op4_url_filter": f"""
        WITH rules(rule, host, path, verdict) AS (VALUES {_RULES_SQL}),
        rest AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        parts AS (
            SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
        fitting AS (
            SELECT p.page_id, p.host, p.path, r.rule, r.verdict,
                   row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule) DESC NULLS LAST) AS best
            FROM parts p LEFT JOIN rules r
              ON ('.' || p.host) LIKE ('%.' || r.host) AND starts_with(p.path, r.path))
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fitting WHERE best = 1""",
    "op12_importance_resampling": """
        WITH steps AS (
            SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z:
                       CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS step
            FROM range(256) r(i)),
        texts AS (
            SELECT 0 AS part, row_number() OVER () AS row, doc_id, text FROM documents
            UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark),
        cut AS (
            SELECT part, row, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
        used AS (
            SELECT part, row, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
            FROM cut),
        grouped AS (SELECT part, row, f, count(*) AS n FROM used GROUP BY ALL),
        hexed AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM grouped)),
        hashed AS (
            SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(h) // 2),
                       lambda j: ('0x' || substr(h, 2 * j + 1, 2))::BIGINT)),
                       lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
            FROM hexed, steps),
        counted AS (
            SELECT bucket, coalesce(sum(n) FILTER (part = 0), 0) AS s, coalesce(sum(n) FILTER (part = 1), 0) AS t
            FROM grouped JOIN hashed USING (f) GROUP BY bucket),
        totals AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM counted),
        gains AS (
            SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE)))::BIGINT AS gain
            FROM counted, totals),
        summed AS (
            SELECT row, sum(n * gain)::BIGINT AS gain, sum(n)::BIGINT AS n
            FROM grouped JOIN hashed USING (f) JOIN gains USING (bucket) WHERE part = 0 GROUP BY row),
        weighed AS (
            SELECT doc_id, len(w) AS words, coalesce(n, 0) AS n_features,
                   coalesce((gain - ((gain % n) + n) % n) // n, 0)::BIGINT AS weight,
                   ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
            FROM cut LEFT JOIN summed USING (row) WHERE part = 0),
        scored AS (
            SELECT *, (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score FROM weighed),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
                   count(*) FILTER (words >= 20) OVER () AS n_long FROM scored)
        SELECT doc_id, n_features, weight, score,
               CASE WHEN words >= 20 AND place <= 25 * n_long // 100 THEN place END AS rank FROM placed""",
    "op13_hard_negatives": """
        WITH usable AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                   list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM usable a JOIN usable c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id),
        own AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, row_number() OVER (
                   PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM own JOIN scored USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY rank <= 3""",
}
