"""End-to-end jobs: JSONL in, training-ready Parquet out.

Each job is what a trainer's data side does for one stage, expressed as
Spark reads, projections, a plan and writes:

* ``prepare_pretrain`` / ``prepare_sft`` / ``prepare_dpo``: A1-A3 -> C1-C3 ->
  Parquet, one row per sample, encoded once (not on every epoch). Malformed
  lines fail the job, or are written to ``rejects``;
* ``plan_epochs``: F1-F7 manifest for given epochs, ranks and batch size,
  optionally resumed from saved progress (E1), written partitioned by epoch;
* ``deliver``: A5, encoded samples joined to the plan and written per
  (epoch, rank) in step order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .fixed import BASE_SEED, DPO_MAX_LENGTH, PRETRAIN_MAX_LENGTH, SFT_MAX_LENGTH
from .operators.encode import encode_dpo, encode_pretrain, encode_sft
from .plans import epochs as P
from .sources import jsonl as J


def prepare_pretrain(spark: SparkSession, src: str, dst: str,
                     max_length: int = PRETRAIN_MAX_LENGTH, tokenizer_factory=None,
                     rejects: str | None = None) -> DataFrame:
    recs = J.with_sample_id(J.checked(J.read_pretrain(spark, src), rejects), "text")
    out = encode_pretrain(recs, max_length=max_length, tokenizer_factory=tokenizer_factory)
    J.write_parquet(out, dst)
    return spark.read.parquet(dst)


def prepare_sft(spark: SparkSession, src: str, dst: str, max_length: int = SFT_MAX_LENGTH,
                tokenizer_factory=None, rejects: str | None = None) -> DataFrame:
    recs = J.with_sample_id(J.checked(J.read_sft(spark, src), rejects), "messages", "tools")
    out = encode_sft(recs, max_length=max_length, tokenizer_factory=tokenizer_factory)
    J.write_parquet(out, dst)
    return spark.read.parquet(dst)


def prepare_dpo(spark: SparkSession, src: str, dst: str, max_length: int = DPO_MAX_LENGTH,
                tokenizer_factory=None, rejects: str | None = None) -> DataFrame:
    recs = (J.with_sample_id(J.checked(J.read_dpo(spark, src), rejects), "chosen", "rejected")
            .withColumnRenamed("sample_id", "pair_id"))
    out = encode_dpo(recs, max_length=max_length, tokenizer_factory=tokenizer_factory)
    J.write_parquet(out, dst)
    return spark.read.parquet(dst)


def plan_epochs(spark: SparkSession, encoded: str, dst: str, epochs: int, world_size: int,
                batch_size: int, seed: int = BASE_SEED, id_col: str = "sample_id",
                progress: dict | None = None) -> DataFrame:
    """Manifest for a run; ``progress`` = saved ``{epoch, step, world_size}``
    resumes it (step rescaled when the world size changed)."""
    ids = spark.read.parquet(encoded).select(id_col)
    m = P.build_manifest(ids, epochs, world_size, batch_size, seed=seed, id_col=id_col)
    if progress:
        skip = P.rescaled_step(int(progress["step"]), int(progress.get("world_size", 1)), world_size)
        m = P.resume(m, int(progress["epoch"]), skip)
    J.write_parquet(m, dst, partition_by=["epoch"])
    return spark.read.parquet(dst)


READER_BATCH_CONF = "spark.sql.parquet.columnarReaderBatchSize"


def deliver(spark: SparkSession, manifest: str, encoded: str, dst: str,
            id_col: str = "sample_id", reader_batch_rows: int | None = 512) -> None:
    """A5. Encoded rows are wide (several arrays of ``max_length`` ints), so
    the Parquet reader batch is lowered for this job and restored after."""
    old = spark.conf.get(READER_BATCH_CONF, None)
    if reader_batch_rows:
        spark.conf.set(READER_BATCH_CONF, str(int(reader_batch_rows)))
    try:
        P.write_training_shards(spark.read.parquet(manifest), spark.read.parquet(encoded), dst, id_col)
    finally:
        if reader_batch_rows:
            if old is None:
                spark.conf.unset(READER_BATCH_CONF)
            else:
                spark.conf.set(READER_BATCH_CONF, old)
