"""Training-log roll-ups.

Step numbers come from the distributed grouped rank, so a run that holds
most of the log is numbered by many tasks. Per-run scalars (``iters``,
start time) are partial aggregates joined back; the latest progress per
run is a ``max_by`` aggregate, not a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ranking import grouped_rank
from ..plans.schedule import is_log_step, step_lr


def micros_between(start: F.Column, end: F.Column) -> F.Column:
    """Microseconds from ``start`` to ``end``; wall-clock arithmetic for
    TIMESTAMP_NTZ, so the result never depends on the session time zone."""
    return F.timestamp_diff("MICROSECOND", start, end)


def epoch_micros(df: DataFrame, ts_col: str) -> F.Column:
    """Monotone, zone-independent micros since 1970 of a timestamp column."""
    from pyspark.sql.types import TimestampNTZType
    if isinstance(df.schema[ts_col].dataType, TimestampNTZType):
        return micros_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts_col))
    return F.unix_micros(F.col(ts_col))


def number_steps(log: DataFrame, run_col: str = "run", ts_col: str = "ts",
                 tiebreak: list[str] | None = None, sub_buckets: int | None = None) -> DataFrame:
    """1-based ``step`` per run in ``(ts, tiebreak)`` order, plus ``iters``."""
    keyed = log.withColumns({"_us": epoch_micros(log, ts_col), "_run": F.struct(run_col)})  # equal for null runs, too
    ranked = grouped_rank(keyed, ["_run"], "_us", tiebreak=tiebreak or [],
                          out_col="_pos", sub_buckets=sub_buckets)
    iters = keyed.groupBy("_run").agg(F.count(F.lit(1)).cast("bigint").alias("iters"),
                                      F.min(ts_col).alias("run_start"))
    return (ranked.join(iters, "_run")
            .withColumn("step", (F.col("_pos") + 1).cast("bigint"))
            .drop("_pos", "_us", "_run"))


def logged_steps(steps: DataFrame, log_interval: int, lr: float, epochs: int = 1,
                 epoch: int = 0) -> DataFrame:
    """E2 + F9: the rows a trainer logs, with their learning rate."""
    s, it = F.col("step"), F.col("iters")
    return (steps.where(is_log_step(s, it, log_interval))
            .withColumn("lr", step_lr(F.lit(epoch), s, it, epochs, lr)))


def eta_minutes(ts: str = "ts", start: str = "run_start") -> F.Column:
    """``spent/(step+1)*iters // 60 - spent // 60`` (minutes), as the
    trainer computes it (after a resume it divides the time since the
    restart by the absolute step)."""
    spent = micros_between(F.col(start), F.col(ts)) / F.lit(1e6)
    return (F.floor(spent / (F.col("step") + 1) * F.col("iters") / 60) - F.floor(spent / 60)).cast("bigint")


def eta_minutes_since_restart(start_step: F.Column, ts: str = "ts", start: str = "run_start") -> F.Column:
    """I2, run-relative variant: rate measured over the steps done since the
    restart (``step - start_step``), applied to the steps still to go."""
    spent = micros_between(F.col(start), F.col(ts)) / F.lit(1e6)
    done = F.col("step") - start_step
    left = F.col("iters") - F.col("step")
    return F.floor(spent / F.greatest(done, F.lit(1)) * left / 60).cast("bigint")


def spent_seconds(ts: str = "ts", start: str = "run_start") -> F.Column:
    return micros_between(F.col(start), F.col(ts)) / F.lit(1e6)


def latest_progress(progress: DataFrame, run_col: str = "run",
                    order_cols: tuple[str, ...] = ("epoch", "step")) -> DataFrame:
    """The latest saved state per run (partial aggregate, hot-run safe)."""
    payload = [c for c in progress.columns if c != run_col]
    key = F.struct(*[F.col(c) for c in order_cols])
    return (progress.groupBy(run_col)
            .agg(F.max_by(F.struct(*payload), key).alias("_p"))
            .select(run_col, "_p.*"))


def append_log(records: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append records to a Parquet log table."""
    w = records.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
