"""JSONL sources (A1-A3) and parquet sinks.

Schemas are explicit: inference scans the whole input, and a wrong guess on
one file changes types for all. Malformed lines land in
``_corrupt_record`` instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.chat import MESSAGES_TYPE, TOOL_CALL_TYPE, choose_tools
from ..session import shared_path

MAX_BROADCAST_DIGESTS = 1_000_000  # repeated contents; 32 characters and a count each
COPIES_A_PIECE = 65_536

PRETRAIN_SCHEMA = "text STRING, _corrupt_record STRING"

_RAW_CALL = ("struct<name:string,arguments:string,"
             "function:struct<name:string,arguments:string>>")
# Content keeps its JSON type: only a string is rendered.
_RAW_MESSAGE = (f"struct<role:string,content:variant,functions:array<string>,"
                f"tool_calls:array<{_RAW_CALL}>>")
SFT_SCHEMA = f"conversations ARRAY<{_RAW_MESSAGE}>, _corrupt_record STRING"
DPO_SCHEMA = (f"chosen ARRAY<{_RAW_MESSAGE}>, rejected ARRAY<{_RAW_MESSAGE}>, "
              "_corrupt_record STRING")

# Scalar part of the resume state and the train-log record.
PROGRESS_SCHEMA = "run STRING, epoch INT, step BIGINT, world_size INT, wandb_id STRING"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    df = (spark.read.schema(schema)
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record")
          .json(path))
    # The file split a row came from; used to spread exact copies.
    split = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"))
    return df.withColumn("_split", split)


def content_digest(*content_cols: str) -> F.Column:
    """128-bit digest of a record's content."""
    return F.md5(F.to_json(F.struct(*content_cols), {"ignoreNullFields": "false"}))


def repeated_digests(keyed: DataFrame, digest_col: str = "_h") -> tuple[DataFrame, int]:
    """``(digest, n)`` of the contents that more than one record has, and the
    number of them; only digests and counts are shuffled. The table is written
    to the shared folder, so it is counted once."""
    path = shared_path(keyed.sparkSession, "repeated-digests")
    counts = keyed.groupBy(digest_col).agg(F.count(F.lit(1)).alias("n"))
    counts.where(F.col("n") > 1).write.parquet(path)
    found = keyed.sparkSession.read.parquet(path)
    return found, found.count()


def _copies_by_count(repeated: DataFrame) -> DataFrame:
    """``_dup`` 0 .. n-1 for each content. Copies are alike, so a map task sends
    one of them with their number, and they are made anew from the sum, in
    pieces of ``COPIES_A_PIECE`` that are spread over tasks."""
    others = [c for c in repeated.columns if c != "_h"]
    counted = repeated.groupBy("_h").agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in others])
    piece = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(COPIES_A_PIECE).cast("bigint")))
    last = F.least(F.col("_lo") + COPIES_A_PIECE, F.col("_n")) - 1
    pieces = counted.withColumn("_lo", piece).repartition("_h", "_lo")
    return pieces.withColumn("_dup", F.explode(F.sequence(F.col("_lo"), last))).drop("_lo", "_n")


def with_sample_id(df: DataFrame, *content_cols: str, split_col: str = "_split",
                   buckets: int = 1024) -> DataFrame:
    """Stable id when the input has none: the content's 128-bit digest, then a
    number among exact copies. Copies are interchangeable, so the set of ids
    is stable.

    Records whose content occurs once, as nearly all do, get their id in place:
    a first pass counts digests, and the repeated ones (a broadcast table, up
    to ``MAX_BROADCAST_DIGESTS``; else a join) tell which records have copies.
    Of those, each map task sends one with its number of copies. If records
    have columns of their own beside the content, copies are no longer alike:
    they are numbered inside ``(digest, split bucket)`` and shifted by the
    counts of earlier buckets, so even a text copied into a third of all rows
    is numbered by many tasks.
    """
    keyed = df.withColumn("_h", content_digest(*content_cols))
    repeated, n = repeated_digests(keyed)
    if n == 0:
        return keyed.withColumn("sample_id", F.concat(F.col("_h"), F.lit("-0"))).drop("_h")
    known = repeated.select("_h")
    known = F.broadcast(known) if n <= MAX_BROADCAST_DIGESTS else known
    lone = keyed.join(known, "_h", "left_anti").withColumn("_dup", F.lit(0).cast("bigint"))
    copies = keyed.join(known, "_h", "left_semi")
    if set(df.columns) <= {*content_cols, "_split", "_corrupt_record"}:
        numbered = _copies_by_count(copies)
    else:
        from ..plans.ranking import rank_in_buckets
        bucket = (F.pmod(F.col(split_col), F.lit(buckets)) if split_col in df.columns else F.lit(0))
        numbered = rank_in_buckets(copies, ["_h"], bucket, [F.lit(1)], out_col="_dup")
    both = lone.unionByName(numbered)
    return both.withColumn("sample_id", F.concat_ws("-", "_h", "_dup")).drop("_h", "_dup")


def read_pretrain(spark: SparkSession, path: str) -> DataFrame:
    """A1: ``(text, _corrupt_record, _split)`` records."""
    return _read(spark, path, PRETRAIN_SCHEMA)


def _normalise_messages(raw: F.Column) -> F.Column:
    """Unwrap ``function`` in tool calls; keep arguments as JSON text. Content
    that isn't a string becomes null, which renders as nothing (D10)."""
    def text(content: F.Column) -> F.Column:
        return F.when(F.schema_of_variant(content) == "STRING", F.try_variant_get(content, "$", "string"))

    return F.transform(raw, lambda m: F.struct(
        m["role"].alias("role"), text(m["content"]).alias("content"),
        F.transform(m["tool_calls"], lambda c: F.struct(
            F.coalesce(c["function"]["name"], c["name"]).alias("name"),
            F.coalesce(c["function"]["arguments"], c["arguments"]).alias("arguments"))
        ).cast(TOOL_CALL_TYPE).alias("tool_calls"))).cast(MESSAGES_TYPE)


def read_sft(spark: SparkSession, path: str) -> DataFrame:
    """A2: chat records -> ``(messages, tools, _corrupt_record)``."""
    return sft_records(_read(spark, path, SFT_SCHEMA))


def sft_records(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Normalise raw chat records (batch or streaming); ``keep`` passes
    columns through (e.g. an id)."""
    extra = list(keep) + [c for c in ("_corrupt_record", "_split") if c in raw.columns]
    return raw.select(
        _normalise_messages(F.col("conversations")).alias("messages"),
        choose_tools(F.col("conversations"),
                     F.get(F.col("conversations"), 0)["functions"]).alias("tools"),
        *extra)


def read_dpo(spark: SparkSession, path: str) -> DataFrame:
    """A3: preference records -> ``(chosen, rejected)`` as message arrays."""
    return dpo_records(_read(spark, path, DPO_SCHEMA))


def dpo_records(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Normalise raw preference records (batch or streaming)."""
    extra = list(keep) + [c for c in ("_corrupt_record", "_split") if c in raw.columns]
    return raw.select(_normalise_messages(F.col("chosen")).alias("chosen"),
                      _normalise_messages(F.col("rejected")).alias("rejected"), *extra)


def checked(df: DataFrame, rejects: str | None = None) -> DataFrame:
    """Records without malformed ones. By default one malformed line fails the
    job; with ``rejects``, such lines are written there as text, and the
    number of them is ``spark.read.text(rejects).count()``."""
    corrupt = F.col("_corrupt_record")
    if rejects:
        # The reader wants a column besides the corrupt one: nothing of it is added.
        fields = F.to_json(F.struct(*[c for c in df.columns if c not in ("_corrupt_record", "_split")]))
        line = F.concat(corrupt, F.substring(F.coalesce(fields, F.lit("")), 1, 0))
        df.where(corrupt.isNotNull()).select(line.alias("value")).write.mode("overwrite").text(rejects)
        return df.where(corrupt.isNull()).drop("_corrupt_record")
    failed = F.raise_error(F.concat(F.lit("malformed record: "), F.substring(corrupt, 1, 200)))
    return df.where(F.when(corrupt.isNull(), True).otherwise(failed.cast("boolean"))).drop("_corrupt_record")


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """A5/A6 sinks. Overwriting removes the old output before the new one is
    there, so saved state (A7) is appended as a new version instead and read
    by ``operators.logs.latest_progress``."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
