"""Queries with SQL against DuckDB; all of them for their columns."""

import duckdb
import pytest
from conftest import SF001
from tokenloom.llm import queries as Q

COLUMNS = {
    "op1_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op2_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op3_lm_scores": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op4_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op5_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op6_main_text": ["page_id", "url", "text", "n_chars"],
    "op7_quality_knn": ["doc_id", "held_out", "score", "predicted"],
    "op8_toxicity_nnpu": ["doc_id", "held_out", "score", "predicted"],
    "op9_bpe_chunks": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op10_near_duplicates": ["doc_id", "n_shingles", "component_id", "kept"],
    "op11_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op12_merkle_manifest": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op13_conversation_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                                 "repaired_sha256"],
}


@pytest.mark.parametrize("name", sorted(Q.REGISTRY))
def test_whole_table_and_columns(spark, name):
    table = {"page_id": "pages", "doc_id": "documents", "conv_id": "conversations"}[COLUMNS[name][0]]
    got = Q.REGISTRY[name](spark, SF001)
    assert got.columns[:len(COLUMNS[name])] == COLUMNS[name]
    rows = spark.read.parquet(f"{SF001}/{table}.parquet")
    assert got.count() == (rows.select("conv_id").distinct() if table == "conversations" else rows).count()


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    want = con.sql(Q.ORACLE_SQL[name]).df()
    got = Q.REGISTRY[name](spark, SF001).toPandas()[list(want.columns)]
    key = list(want.columns)
    assert got.sort_values(key).reset_index(drop=True).astype(str).equals(
        want.sort_values(key).reset_index(drop=True).astype(str))
