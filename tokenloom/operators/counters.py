"""K3 from stored counters: length reports that grow with new files only.

The state of a report is one counter for each distinct length in a group. It
merges by addition, so counters of each input are written once, under the
input's name, and a report over any set of inputs reads counters, never texts.
Quantiles are exact: they come from cumulative counts over the lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.tokens import coerce_text, token_count
from ..plans.ranking import join_on

SOURCE = "source"


def length_counters(records: DataFrame, group_cols: list[str], text_col: str = "text",
                    length: Column | None = None) -> DataFrame:
    """``(groups, n_tokens, n)``; counted on the map side. ``length`` replaces
    the byte tokenizer's count."""
    n = token_count(coerce_text(F.col(text_col))) if length is None else length.cast("bigint")
    return records.groupBy(*group_cols, n.alias("n_tokens")).agg(F.count(F.lit(1)).alias("n"))


def merge_counters(counters: DataFrame, group_cols: list[str]) -> DataFrame:
    """One counter a length from those of several inputs."""
    return counters.groupBy(*group_cols, "n_tokens").agg(F.sum("n").alias("n"))


def store_counters(counters: DataFrame, path: str, source: str) -> None:
    """Write the counters of one input; writing them again replaces them."""
    counters.write.mode("overwrite").parquet(f"{path}/{SOURCE}={source}")


def stored_counters(spark: SparkSession, path: str, group_cols: list[str]) -> DataFrame:
    """The state over all stored inputs."""
    return merge_counters(spark.read.parquet(path), group_cols)


def report_from_counters(counters: DataFrame, group_cols: list[str], max_length: int, reserved: int = 2,
                         quantiles: tuple[float, ...] = (0.5,)) -> DataFrame:
    """What ``report.length_report`` gives, and ``q<percent>_tokens``: the
    least length that the share ``q`` of the documents doesn't exceed."""
    L = int(max_length)
    n, each = F.col("n"), F.col("n_tokens")
    kept = F.least(each, F.lit(L - reserved)) + F.lit(reserved)
    sums = counters.groupBy(*group_cols).agg(
        F.sum("n").alias("n_docs"), F.sum(n * each).alias("total_tokens"), F.max("n_tokens").alias("max_tokens"),
        F.sum(F.when(each > L - reserved, n).otherwise(0)).alias("n_truncated"), F.sum(n * (L - kept)).alias("_pad"))
    before = Window.partitionBy(*group_cols).orderBy("n_tokens")
    ranked = join_on(counters.withColumn("_upto", F.sum("n").over(before)), sums.select(*group_cols, "n_docs"), group_cols)
    marks = ranked.groupBy(*group_cols).agg(*[
        F.min(F.when(F.col("_upto") >= F.col("n_docs") * F.lit(q), each)).alias(f"q{round(q * 100)}_tokens")
        for q in quantiles])
    return (join_on(sums, marks, group_cols)
            .withColumn("avg_tokens", F.col("total_tokens") / F.col("n_docs"))
            .withColumn("pad_share", F.col("_pad") / (F.col("n_docs") * L)).drop("_pad"))
