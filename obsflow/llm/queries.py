"""One query per operator, over whole tables with production parameters, and checking SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from obsflow.llm import (
    bpe, centroid_clusters, mixing, nearest, ngram_join, prefix_free, quality_rules, spelling, substring_dedup, token_counts,
    token_files, toxicity, url_filter,
)
from obsflow.llm.common import table

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op2_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), rules)


def op3_token_counts(spark, sf_dir):
    return token_counts.section_token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


def op4_ngram_join(spark, sf_dir):
    return ngram_join.document_components(table(spark, sf_dir, "documents"))


def op5_token_files(spark, sf_dir):
    back = token_files.token_files(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1
    )
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality_rules.judge_documents(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_source_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"),
    )


def op8_substring_dedup(spark, sf_dir):
    return substring_dedup.dedup_report(table(spark, sf_dir, "documents"))


def op9_nearest_vectors(spark, sf_dir):
    return nearest.nearest_vectors(table(spark, sf_dir, "embeddings"))


def op10_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.bpe_round_trip(docs, public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", (F.octet_length("bpe_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("bpe_ids", 256).alias("ids_sha256"), F.sha2("bpe_decoded", 256).alias("decoded_sha256"),
    )


def op11_suffix_array_dedup(spark, sf_dir):
    return prefix_free.dedup_bytes(table(spark, sf_dir, "documents"), length=100).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op12_centroid_clusters(spark, sf_dir):
    return centroid_clusters.centroid_clusters(table(spark, sf_dir, "embeddings"), k=8, rounds=10, size=64, scale=1024, seed="3:")


def op13_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), shortest=7, least=2, factor=10, damage=31)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_url_filters": op2_url_filters,
    "op3_token_counts": op3_token_counts,
    "op4_ngram_join": op4_ngram_join,
    "op5_token_files": op5_token_files,
    "op6_quality_rules": op6_quality_rules,
    "op7_source_mixing": op7_source_mixing,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_nearest_vectors": op9_nearest_vectors,
    "op10_bpe": op10_bpe,
    "op11_suffix_array_dedup": op11_suffix_array_dedup,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL = {
    "op2_url_filters": r"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r
  FROM pages
), parts AS (
  SELECT row_number() OVER () AS n, page_id,
    translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), rules(rule_host, rule_path, action) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), best AS (
  SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(action, length(rule_host || rule_path)) AS action
  FROM parts JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN best USING (n)
""",
    "op7_source_mixing": r"""
WITH sized AS (
  SELECT row_number() OVER () AS n, doc_id, source, coalesce(text, '') AS text,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), keyed AS (
  SELECT n, doc_id, source, size,
    -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 1)::DOUBLE / 4503599627370496.0)
      / ((size + 1.0::DOUBLE) / (size + length(text) - length(translate(text, '#*$%&|<>', '')) + 1.0::DOUBLE)) AS key
  FROM sized
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
    sum(source_size) OVER () AS everything FROM sources
), levels AS (
  SELECT *, (1.5::DOUBLE * everything - coalesce(sum(2 * source_size) OVER w, 0)) / sum(weight) OVER v AS level,
    (2 * source_size)::DOUBLE / weight AS ratio
  FROM weighed
  WINDOW w AS (ORDER BY (2 * source_size)::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    v AS (ORDER BY (2 * source_size)::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), final AS (
  SELECT arg_min(level, ratio) AS final FROM levels WHERE level <= ratio
), targets AS (
  SELECT source, source_size, least((2 * source_size)::DOUBLE, final.final * weight) AS target FROM levels, final
), placed AS (
  SELECT k.*, t.source_size, t.target,
    sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CASE WHEN size = 0 THEN 0 ELSE size * (floor(target / source_size)
    + CASE WHEN 2 * upto - size <= 2 * (target - floor(target / source_size) * source_size) THEN 1 ELSE 0 END) END::BIGINT AS taken
FROM placed
""",
}
