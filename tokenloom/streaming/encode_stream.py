"""K4: the stateless encoders over arriving files (Structured Streaming).

C1-C3 are projections, so the streaming plan is the batch plan over each
micro-batch; output is appended to Parquet with a checkpoint, which makes
the sink exactly-once across restarts. A malformed record stops the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def stream_files(spark: SparkSession, path: str, schema, fmt: str = "json",
                 glob: str | None = None, max_files_per_trigger: int | None = None,
                 spread: int | None = None) -> DataFrame:
    """File stream source. ``spread``: round-robin each micro-batch over that
    many partitions (for few large files feeding CPU-heavy encoders)."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.load(path)
    return df.repartition(spread) if spread else df


def stream_table(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table as a stream, be it one file or a folder of files. The
    source takes a plain path for a folder; a pattern may match either."""
    folder, name = path.rstrip("/").rsplit("/", 1)
    return stream_files(spark, f"{folder}/{{{name}}}", schema, fmt="parquet",
                        max_files_per_trigger=max_files_per_trigger)


def start_append(df: DataFrame, sink: str, checkpoint: str, available_now: bool = True,
                 processing_time: str | None = None) -> StreamingQuery:
    w = df.writeStream.format("parquet").option("path", sink) \
        .option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def stream_chat_records(spark: SparkSession, path: str, id_field: str = "id",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """A2 as a stream: JSONL chat records with an id field, normalised like
    the batch reader (tool-call unwrap, tool choice)."""
    from ..sources.jsonl import SFT_SCHEMA, checked, sft_records
    raw = stream_files(spark, path, f"{id_field} LONG, {SFT_SCHEMA}", fmt="json",
                       max_files_per_trigger=max_files_per_trigger)
    return checked(sft_records(raw, keep=(id_field,)))


def stream_preference_records(spark: SparkSession, path: str, id_field: str = "id",
                              max_files_per_trigger: int | None = None) -> DataFrame:
    """A3 as a stream."""
    from ..sources.jsonl import DPO_SCHEMA, checked, dpo_records
    raw = stream_files(spark, path, f"{id_field} LONG, {DPO_SCHEMA}", fmt="json",
                       max_files_per_trigger=max_files_per_trigger)
    return checked(dpo_records(raw, keep=(id_field,)))
