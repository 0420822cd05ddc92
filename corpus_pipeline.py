"""A corpus pipeline from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet in the shared folder and read again for the next stage.
All stages but the last return the columns of ``docs``. Rows with null ids or
texts pass through the operators' defined cases; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import bottomk_dedup, bpe_chunks, decontaminate, quality_knn, toxicity_nnpu
from tokenloom.llm.common import read_table
from tokenloom.llm.queries import tokenizer_path
from tokenloom.session import shared_path

_SCORE = "__score"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that are more likely good than bad."""
    model = quality_knn.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    scored = quality_knn.with_scores(docs, model.scores, _SCORE)
    return scored.where(F.col(_SCORE) >= 0.5).select(docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that are more likely clean than toxic."""
    model = toxicity_nnpu.fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    scored = quality_knn.with_scores(docs, model.scores, _SCORE)
    return scored.where(F.col(_SCORE) < 0.5).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each group of near copies."""
    return bottomk_dedup.keep_one(docs, shingle=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the texts; the ids and digests stand in the texts' place."""
    return bpe_chunks.encode_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("bpe", bpe)]

#: The classifiers and the vocabulary are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    home = shared_path(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = f"{home}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
