"""One query per operator with production parameters over its whole table, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crmweave.llm import (
    decontaminate,
    exact_dedup,
    hard_negatives,
    lexical_search,
    license_scan,
    maxent_lm,
    packing,
    quality,
    sharding,
    simhash,
    suffix_dedup,
    token_count,
    url_filter,
)
from crmweave.llm.common import pick, table

SHARDS = 24
COUNTED, PACKED = "byte_bpe_50k.json", "word_bpe_49k.json"
TOKEN_LIMIT, SEQUENCE, END = 512, 4096, 1
# Host, path and verdict of the rules that every URL is held against.
URL_RULES = """
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
           ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
"""


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op2_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(table(spark, sf_dir, "documents")).drop("spans")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_digest(license_scan.scan_licenses(table(spark, sf_dir, "documents")))


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_manifest(table(spark, sf_dir, "documents"), SHARDS)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path(COUNTED)
    return token_count.count_tokens(table(spark, sf_dir, "documents"), vocabulary, TOKEN_LIMIT)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH normal AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
    FROM documents
), grouped AS (
    SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
           first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id
    FROM normal
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM grouped
"""


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.find_leaks(docs, items)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.score_documents(docs, labels)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path(PACKED)
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary, SEQUENCE, END)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(URL_RULES).toDF("host", "path", "verdict")
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), rules)


OP10_SQL = rf"""
WITH parsed AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), rules(rule_host, rule_path, verdict) AS ({URL_RULES}), ruled AS (
    SELECT *, (SELECT max({{'n': length(rule_host || rule_path),
                           'rule': rule_host || rule_path, 'verdict': verdict}})
               FROM rules
               WHERE (host = rule_host OR ends_with(host, '.' || rule_host))
                 AND starts_with(path, rule_path)) AS best
    FROM parsed
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM ruled
"""


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row's label is moved on by one first."""
    vectors = pick(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    moved = F.expr("if(vec_id % 7 = 0, (bigint(label) + 1) % 10, label)")
    return hard_negatives.mine(vectors.withColumn("label", moved), "vec_id % 50 = 0", 5, 3, 50, 95)


OP11_SQL = r"""
WITH held AS (
    SELECT row_number() OVER () AS r, vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id, a.label = b.label AS alike,
           list_inner_product(a.v::DOUBLE[], b.v::DOUBLE[])::BIGINT AS score
    FROM held a, held b WHERE a.vec_id % 50 = 0 AND a.r <> b.r
), positives AS (
    SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, b) AS place
    FROM scored WHERE alike
), negatives AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
           p.score AS positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.a, p.place ORDER BY n.score DESC, n.vec_id, n.b)::INTEGER AS rank
    FROM positives p JOIN scored n ON n.a = p.a AND NOT n.alike
     AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
    WHERE p.place <= 5
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 3
"""

def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.score_documents(table(spark, sf_dir, "documents"), folds=10)


RESULTS = 20


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return lexical_search.search(docs, items, RESULTS)


OP13_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents
), sized AS (
    SELECT row_number() OVER () AS r, doc_id, words, len(words) AS n FROM words WHERE len(words) > 0
), corpus AS (
    SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM sized
), tfs AS (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM sized) GROUP BY r, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM tfs, corpus GROUP BY term, big_n
), asked AS (
    SELECT item_id, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)
), scored AS (
    SELECT item_id, doc_id, r,
           sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN sized USING (r), corpus
    GROUP BY item_id, doc_id, r
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_repeated_spans": op2_repeated_spans,
    "op3_licenses": op3_licenses,
    "op4_shards": op4_shards,
    "op5_token_counts": op5_token_counts,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_quality": op8_quality,
    "op9_packing": op9_packing,
    "op10_url_filter": op10_url_filter,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_lm_scores": op12_lm_scores,
    "op13_lexical_search": op13_lexical_search,
}
ORACLES = {
    "op6_exact_dedup": OP6_SQL,
    "op10_url_filter": OP10_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op13_lexical_search": OP13_SQL,
}
