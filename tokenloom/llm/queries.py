"""Registered queries of this package: each applies one operator, with its
production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bottomk_dedup, bpe_chunks, conversation_repair, decontaminate, fingerprints, html_extract,
               license_templates, lm_scoring, merkle, quality_knn, token_frames, toxicity_nnpu, url_filter)
from .common import fold_column, read_table

#: Folder of the public tokenizers' files; None: as the package names it.
TOKENIZER_DIR: str | None = None


def tokenizer_path(name: str) -> str:
    if TOKENIZER_DIR:
        return f"{TOKENIZER_DIR}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on every page's url. The labelled urls are those that a rule
    decides (a bounded sample of them, ``url_filter.MAX_LABELLED``)."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    ruled = url_filter.with_rules(pages).withColumn("verdict", F.col("rule_verdict"))
    model = url_filter.fit_url_model(ruled)
    return (url_filter.filter_urls(pages, model)
            .select("page_id", "host", "path", "rule", "verdict", "block_score"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_neighbours(read_table(spark, sf_dir, "documents"))


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.learn_and_score(read_table(spark, sf_dir, "documents"), fold=5, held_out=1, least_context=1)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_frames.token_digests(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(read_table(spark, sf_dir, "pages"))


def _labelled(scored: DataFrame, fold: int, held_out: int) -> DataFrame:
    return scored.select("doc_id", (fold_column(F.col("doc_id"), fold) == held_out).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = quality_knn.fit_quality(docs, labels, fold=3, held_out=1)
    return _labelled(quality_knn.score_quality(docs.select("doc_id", "text"), model), 3, 1)


def op8_toxicity_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity_nnpu.fit_toxicity(docs, labels, fold=5, held_out=0)
    return _labelled(toxicity_nnpu.score_toxicity(docs.select("doc_id", "text"), model), 5, 0)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(read_table(spark, sf_dir, "documents"),
                                              read_table(spark, sf_dir, "benchmark"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bottomk_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=2, similarity=0.8)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_chunks.encoding_digests(docs, tokenizer_path("word_bpe_49k.json"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_fingerprints": op2_fingerprints,
    "op3_lm_scores": op3_lm_scores,
    "op4_token_files": op4_token_files,
    "op5_decontamination": op5_decontamination,
    "op6_main_text": op6_main_text,
    "op7_quality_knn": op7_quality_knn,
    "op8_toxicity_nnpu": op8_toxicity_nnpu,
    "op9_bpe_chunks": op9_bpe_chunks,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_license_scan": license_templates.op11_license_scan,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_conversation_repair": conversation_repair.op13_conversation_repair,
}

#: DuckDB statements of those queries that SQL can express.
ORACLE_SQL: dict[str, str] = {"op5_decontamination": decontaminate.ORACLE_SQL,
                              "op12_merkle_manifest": merkle.ORACLE_SQL}
