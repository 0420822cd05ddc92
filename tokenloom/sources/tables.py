"""Readers for the parquet tables and the record views derived from them.

Every reader names the columns it needs, so the scan reads only those
(``ReadSchema`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def pretrain_records(spark: SparkSession, base: str) -> DataFrame:
    """documents -> pretrain records ``(sample_id, text)``."""
    return table(spark, base, "documents").select(F.col("doc_id").alias("sample_id"), "text")


def turns(spark: SparkSession, base: str) -> DataFrame:
    """conversations -> turns ``(conv_id, turn, role, content)``."""
    return table(spark, base, "conversations").select(
        "conv_id", "turn", "role", F.col("text").alias("content"))


def token_scores(spark: SparkSession, base: str) -> DataFrame:
    """embeddings as model output (FIXTURES.md, "Token scores").

    One row per token: ``seq_id``, ``pos``, policy ``logits`` (the
    embedding, in double), reference logits (half of it), gold ``label``,
    ``mask``, ``pair_id`` and ``side``.
    """
    e = table(spark, base, "embeddings")
    seq = F.floor(F.col("vec_id") / 10).cast("bigint")
    pos = (F.col("vec_id") % 10).cast("int")
    logits = F.transform("embedding", lambda x: x.cast("double"))
    return e.select(
        seq.alias("seq_id"), pos.alias("pos"),
        logits.alias("logits"),
        F.transform(logits, lambda x: x * F.lit(0.5)).alias("ref_logits"),
        F.col("label").cast("int").alias("label"),
        F.when((pos >= 3) & (seq % 7 != 0), F.lit(1)).otherwise(F.lit(0)).alias("mask"),
        F.floor(seq / 2).cast("bigint").alias("pair_id"),
        F.when(seq % 2 == 0, F.lit("chosen")).otherwise(F.lit("rejected")).alias("side"))


def step_log(spark: SparkSession, base: str) -> DataFrame:
    """events as a training step log: ``run = user_id``, ``loss = value``.

    ``step`` (1-based, ordered by ts then event_id) and ``iters`` are added
    by :func:`tokenloom.operators.logs.number_steps`.
    """
    return table(spark, base, "events").select(
        F.col("user_id").alias("run"), "ts", "event_id", F.col("value").alias("loss"))
