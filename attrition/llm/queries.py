"""Registered queries of the corpus operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.llm import (
    centroids, common, decontaminate, fingerprints, licenses, line_dedup, ngram_join, packing, prefix_trie,
    quality_lines, secrets, token_counts, toxicity, warc,
)

VOCABULARY = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(oracle: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLE_SQL[fn.__name__] = oracle
        return fn
    return deco


def documents(spark, sf_dir) -> DataFrame:
    return common.table(spark, sf_dir, "documents")


@query()
def op1_token_counts(spark, sf_dir):
    out = token_counts.count_tokens(documents(spark, sf_dir).select("doc_id", "text"),
                                    public_tokenizers.path(VOCABULARY))
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query(line_dedup.ORACLE)
def op2_line_dedup(spark, sf_dir):
    out = line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(common.text_of(), 256).alias("kept_sha256"))


@query()
def op3_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir).select("doc_id", "text"),
                        public_tokenizers.path(VOCABULARY))


@query(decontaminate.ORACLE)
def op7_decontamination(spark, sf_dir):
    return decontaminate.find_items(documents(spark, sf_dir).select("doc_id", "text"),
                                    common.table(spark, sf_dir, "benchmark"))


@query()
def op10_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))


@query()
def op8_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.train_on_labels(docs, common.table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query()
def op4_fingerprints(spark, sf_dir):
    return fingerprints.edited_fingerprints(documents(spark, sf_dir).select("doc_id", "text"))


#: DuckDB SQL of the round trip's result.
WARC_ORACLE = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n::BIGINT AS payload_bytes, p.d AS payload_digest,
       CASE WHEN first < page_id OR page_id IS NULL AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id OR page_id IS NULL THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d
"""


@query(WARC_ORACLE)
def op6_warc(spark, sf_dir):
    captures = warc.round_trip(common.table(spark, sf_dir, "pages"), each_row=True)
    own = F.col("response.type") == "response"
    return captures.select(
        "page_id",
        F.when(own, F.octet_length("response.payload")).otherwise(F.col("response.payload_bytes"))
        .cast("long").alias("payload_bytes"),
        F.when(own, F.sha2("response.payload", 256)).otherwise(F.col("response.digest")).alias("payload_digest"),
        F.col("response.type").alias("record_type"), "refers_to")


@query()
def op9_secrets(spark, sf_dir):
    return secrets.scan(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


@query()
def op5_licenses(spark, sf_dir):
    """Documents as files source/lang/doc_id."""
    docs = documents(spark, sf_dir).select(
        "doc_id", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"), "text")
    found = common.stored(licenses.headers(docs).drop("text"), "license-headers")
    return licenses.inherit(found).select(
        "doc_id", "path", "header_license", F.round("header_score", 6).alias("header_score"),
        "license", "license_from", "license_distance")


@query(prefix_trie.ORACLE)
def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(common.table(spark, sf_dir, "conversations"))


@query()
def op12_quality_rules(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    weights = quality_lines.train(docs, common.table(spark, sf_dir, "labels"))
    return quality_lines.judge(docs, weights).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "content_share")


@query(centroids.oracle())
def op13_centroids(spark, sf_dir):
    return centroids.cluster(common.table(spark, sf_dir, "embeddings"))
