"""Generation in batches of bounded size, resumable.

A model pads the prompts of a batch to the longest of them. Prompts are put
into width classes (an eighth of an octave apart, so padding stays below one
eighth), numbered within their class in order of length, and cut into batches
of as many as the token budget holds at that width. Numbers come from sorted
ranges, so a class that holds most prompts is numbered by many tasks; a batch
is one group of at most ``max_padded_tokens`` ids, or a single longer prompt.

``generate_to`` deals prompts into rounds by a hash of their key and commits
each round's output; a rerun leaves out the prompts that have an output.
"""

from __future__ import annotations

from typing import Callable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from ..functions.util import worker_instance
from ..plans.ranges import group_positions
from ..plans.ranking import join_on

WIDTH, NUMBER = "batch_width", "batch_no"
STEPS_AN_OCTAVE = 8


def width_class(length: Column) -> Column:
    """Least width of at least ``length``: multiples of an eighth of the power
    of two below it (every length up to 8 is a width of its own)."""
    n = F.greatest(length, F.lit(1)).cast("bigint")
    bits = F.length(F.conv(n.cast("string"), 10, 2))  # of the number
    step = F.greatest(F.pow(F.lit(2), bits - 4), F.lit(1)).cast("bigint")
    return F.ceil(n / step).cast("bigint") * step


def pack(prompts: DataFrame, key_cols: list[str], max_padded_tokens: int, ids_col: str = "prompt_ids") -> DataFrame:
    """Add ``batch_width`` and ``batch_no``: the batch that a prompt is in."""
    sized = prompts.withColumns({"_len": F.size(ids_col), WIDTH: width_class(F.size(ids_col))})
    placed = group_positions(sized, [WIDTH], ["_len", *key_cols], out_col="_at")
    rows = F.greatest(F.floor(F.lit(int(max_padded_tokens)) / F.col(WIDTH)), F.lit(1))
    return placed.withColumn(NUMBER, F.floor(F.col("_at") / rows).cast("bigint")).drop("_at", "_len")


def batch_report(packed: DataFrame, ids_col: str = "prompt_ids") -> DataFrame:
    """Per width: batches, prompts, tokens, padded tokens (the longest times
    the rows of each batch) and the largest batch."""
    each = packed.groupBy(WIDTH, NUMBER).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.size(ids_col)).cast("bigint").alias("tokens"),
        (F.max(F.size(ids_col)) * F.count(F.lit(1))).cast("bigint").alias("padded"))
    return each.groupBy(WIDTH).agg(
        F.count(F.lit(1)).alias("n_batches"), F.sum("rows").alias("n_prompts"), F.sum("tokens").alias("n_tokens"),
        F.sum("padded").alias("n_padded"), F.max("padded").alias("largest"))


def generate_packed(packed: DataFrame, predictor_factory: Callable, ids_col: str = "prompt_ids",
                    out_col: str = "output_ids") -> DataFrame:
    """J3 a batch at a time: the predictor gets the prompts of one batch."""
    schema = StructType(list(packed.schema.fields)).add(out_col, ArrayType(IntegerType()))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf[out_col] = worker_instance(predictor_factory)([list(x) for x in pdf[ids_col]])
        return pdf

    return packed.groupBy(WIDTH, NUMBER).applyInPandas(run, schema).drop(WIDTH, NUMBER)


def without_output(prompts: DataFrame, key_cols: list[str], path: str) -> DataFrame:
    """Prompts that have no row in the output written at ``path`` (null keys
    are equal); all of them if nothing is there yet."""
    try:
        done = prompts.sparkSession.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return prompts
    return join_on(prompts, done.select(*key_cols), key_cols, "left_anti")


def generate_to(prompts: DataFrame, key_cols: list[str], path: str, predictor_factory: Callable,
                max_padded_tokens: int, rounds: int = 8, ids_col: str = "prompt_ids") -> DataFrame:
    """Generate for all prompts that have no output at ``path`` yet, round by
    round; each round is an append of its own, so a killed run loses at most
    one of them. Returns the whole output."""
    deal = F.pmod(F.xxhash64(*key_cols), F.lit(int(rounds)))
    for k in range(int(rounds)):
        left = without_output(prompts.where(deal == k), key_cols, path)
        out = generate_packed(pack(left, key_cols, max_padded_tokens, ids_col), predictor_factory, ids_col)
        out.write.mode("append").parquet(path)
    return prompts.sparkSession.read.parquet(path)
