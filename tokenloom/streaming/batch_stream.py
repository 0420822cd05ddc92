"""K4 + A7: streams that keep rejected lines and their progress.

Each micro-batch writes three folders named by its id: encoded samples, the
malformed lines, and one progress row, written last. A batch that is run again
(after a failure, the same id has the same files) replaces its own folders and
nothing else, so a replay changes nothing; a batch without a progress row
isn't finished and isn't read.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

CORRUPT = "_corrupt_record"
BATCH = "batch"
PROGRESS_DDL = "run string, epoch int, step bigint, n_samples bigint, n_rejects bigint"


def write_batch(records: DataFrame, batch_id: int, home: str, encode: Callable[[DataFrame], DataFrame],
                run: str = "stream") -> None:
    """One batch of parsed records (malformed ones have ``_corrupt_record``)."""
    spark, place = records.sparkSession, f"{BATCH}={int(batch_id)}"
    fields = [c for c in records.columns if c != CORRUPT]
    bad = F.col(CORRUPT).isNotNull()
    # The reader wants a column besides the corrupt one: nothing of it is kept.
    line = F.concat(F.col(CORRUPT), F.substring(F.coalesce(F.to_json(F.struct(*fields)), F.lit("")), 1, 0))
    encode(records.where(~bad).drop(CORRUPT)).write.mode("overwrite").parquet(f"{home}/samples/{place}")
    records.where(bad).select(line.alias("line")).write.mode("overwrite").parquet(f"{home}/rejects/{place}")
    counts = [spark.read.parquet(f"{home}/{part}/{place}").count() for part in ("samples", "rejects")]
    row = spark.createDataFrame([(run, 0, int(batch_id), *counts)], PROGRESS_DDL)
    row.write.mode("overwrite").parquet(f"{home}/progress/{place}")


def start_batches(records: DataFrame, home: str, checkpoint: str, encode: Callable[[DataFrame], DataFrame],
                  run: str = "stream", available_now: bool = True, processing_time: str = "1 minute") -> StreamingQuery:
    """Run a stream of parsed records through ``write_batch``."""
    w = records.writeStream.foreachBatch(lambda df, k: write_batch(df, k, home, encode, run)) \
        .option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)).start()


def finished(spark: SparkSession, home: str, part: str = "samples") -> DataFrame:
    """``samples`` or ``rejects`` of the batches that have a progress row; the
    rows of progress are few (one a batch) and are broadcast."""
    done = spark.read.parquet(f"{home}/progress").select(F.col("step").cast("int").alias(BATCH))
    rows = spark.read.parquet(f"{home}/{part}")
    return rows.join(F.broadcast(done), BATCH, "left_semi").select(rows.columns)


def progress(spark: SparkSession, home: str) -> DataFrame:
    """One row a finished batch: ``(run, epoch, step, n_samples, n_rejects)``;
    ``operators.logs.latest_progress`` gives the latest."""
    return spark.read.parquet(f"{home}/progress").drop(BATCH)
