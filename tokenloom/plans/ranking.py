"""Distributed ranks: ``row_number()`` without a window over a whole group.

``row_number() over (order by k)`` on all rows runs in a single task, and
``partition by g`` runs a hot group in one task. Here the order key is
first mapped to an order-preserving bucket, rows are numbered inside
``(group, bucket)`` and shifted by the prefix sum of the bucket counts.
The counts table has at most ``groups x buckets`` rows; for few groups the
prefix sum and its join are small however large the input is.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_ROWS_PER_BUCKET = 4_000_000


def hex_prefix_bucket(key: Column, digits: int = 4) -> Column:
    """Bucket of a hex digest by its leading digits (uniform for md5)."""
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("int")


def rank_in_buckets(df: DataFrame, partition_cols: list[str], bucket: Column,
                    order_cols: list[Column], out_col: str = "pos",
                    broadcast_offsets: bool | None = None) -> DataFrame:
    """0-based rank within ``partition_cols`` ordered by ``order_cols``.

    ``bucket`` must be non-decreasing in ``order_cols`` within a group.
    ``broadcast_offsets``: True when the caller bounds groups x buckets
    (e.g. epochs x 65,536); None leaves the choice to AQE's run-time size.
    """
    pcols = list(partition_cols)
    b = df.withColumn("_bucket", bucket)
    counts = b.groupBy(*pcols, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = (Window.partitionBy(*pcols) if pcols else Window.partitionBy(F.lit(0))) \
        .orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*pcols, "_bucket",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    if broadcast_offsets:
        offsets = F.broadcast(offsets)
    joined = join_on(b, offsets, [*pcols, "_bucket"])
    w = Window.partitionBy(*pcols, "_bucket").orderBy(*order_cols)
    return (joined.withColumn(out_col, (F.col("_offset") + F.row_number().over(w) - 1).cast("bigint"))
            .drop("_bucket", "_offset"))


def buckets_for(n_rows: int, rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> int:
    return max(1, math.ceil(n_rows / rows_per_bucket))


def join_on(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys are equal; the columns of ``left`` and the
    other columns of ``right``."""
    other = right.select(*[F.col(c).alias(f"__{c}") if c in cols else F.col(c) for c in right.columns])
    on = F.lit(True)
    for c in cols:
        on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return left.join(other, on, how).drop(*[f"__{c}" for c in cols])


def _hot_group_buckets(df: DataFrame, group_cols: list[str], order_col: str,
                       sub_buckets: int | None, rows_per_bucket: int) -> tuple[DataFrame, Column | None]:
    """Order-preserving slice id per row; None when every group is small.

    Group sizes are measured first. Groups above ``rows_per_bucket`` rows
    are cut at their own approximate quantiles into enough slices for the
    largest group; smaller groups stay whole (slice 0). ``sub_buckets``
    forces the slice count for every group (tests).
    """
    sizes = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_gn"))
    if sub_buckets is None:
        largest = sizes.agg(F.max("_gn")).first()[0] or 0
        sub_buckets = buckets_for(largest, rows_per_bucket)
        hot = sizes.where(F.col("_gn") > rows_per_bucket)
    else:
        hot = sizes
    if sub_buckets <= 1:
        return df, None
    probs = [i / sub_buckets for i in range(1, sub_buckets)]
    bounds = (join_on(df, hot.select(*group_cols), group_cols, "left_semi")
              .groupBy(*group_cols)
              .agg(F.percentile_approx(F.col(order_col), probs, 10000).alias("_bounds")))
    src = join_on(df, bounds, group_cols, "left")
    return src, F.coalesce(F.size(F.filter("_bounds", lambda x: x < F.col(order_col))), F.lit(0))


def grouped_rank(df: DataFrame, group_cols: list[str], order_col: str,
                 tiebreak: list[str] | None = None, out_col: str = "pos",
                 sub_buckets: int | None = None,
                 rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """0-based rank within groups over a numeric ``order_col``; a group
    holding a third of the data is numbered by many tasks."""
    order = [F.col(order_col)] + [F.col(c) for c in (tiebreak or [])]
    src, bucket = _hot_group_buckets(df, group_cols, order_col, sub_buckets, rows_per_bucket)
    if bucket is None:
        w = Window.partitionBy(*group_cols).orderBy(*order)
        return df.withColumn(out_col, (F.row_number().over(w) - 1).cast("bigint"))
    return rank_in_buckets(src, group_cols, bucket, order, out_col=out_col).drop("_bounds")


def grouped_running_total(df: DataFrame, group_cols: list[str], order_col: str, value: Column,
                          out_col: str, inclusive: bool = True, tiebreak: list[str] | None = None,
                          sub_buckets: int | None = None,
                          rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """Running sum of ``value`` within groups in ``order_col`` order, with the
    same hot-group slicing as :func:`grouped_rank` (slice totals are
    prefix-summed over a small table)."""
    order = [F.col(order_col)] + [F.col(c) for c in (tiebreak or [])]
    frame_end = 0 if inclusive else -1
    src, bucket = _hot_group_buckets(df, group_cols, order_col, sub_buckets, rows_per_bucket)
    src = src.withColumn("_v", value)
    if bucket is None:
        w = Window.partitionBy(*group_cols).orderBy(*order).rowsBetween(Window.unboundedPreceding, frame_end)
        return src.withColumn(out_col, F.coalesce(F.sum("_v").over(w), F.lit(0))).drop("_v")
    b = src.withColumn("_bucket", bucket)
    totals = b.groupBy(*group_cols, "_bucket").agg(F.sum("_v").alias("_t"))
    before = Window.partitionBy(*group_cols).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group_cols, "_bucket", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    w = Window.partitionBy(*group_cols, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, frame_end)
    return (join_on(b, offsets, [*group_cols, "_bucket"])
            .withColumn(out_col, F.col("_off") + F.coalesce(F.sum("_v").over(w), F.lit(0)))
            .drop("_bucket", "_off", "_v", "_bounds"))
