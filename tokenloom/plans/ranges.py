"""Tables cut into sorted ranges: positions, ranks and successors.

Rows are range-partitioned by their order, sorted within each range and
written to the shared folder with the range's number and the row's place in
it. What is left to do is arithmetic on the ranges: only one row for each of
them (a row count, the sizes of the groups at its ends) reaches the driver and
comes back as a broadcast table, so a plan has the same size however many
ranges there are.

Equal rows are told apart by a number that the first write gives them, so a
key that holds a third of the rows (nulls, too) is spread over many ranges.
Both writes happen when the function is called; from then on the numbers
are fixed, also when executors are lost and tasks run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_path

RANGE, PLACE, TIE = "_range", "_place", "_tie"
_PLACE_BITS = 33  # of monotonically_increasing_id


def sorted_ranges(df: DataFrame, order_cols: list[str], unique: bool = False, n_ranges: int | None = None) -> DataFrame:
    """``df`` sorted by ``order_cols`` (nulls first) in ranges, with the
    columns ``_range`` and ``_place``. ``unique``: no two rows are equal in
    ``order_cols``, which saves the first write."""
    spark, home = df.sparkSession, shared_path(df.sparkSession, "ranges")
    order = list(order_cols)
    if not unique:
        df.withColumn(TIE, F.monotonically_increasing_id()).write.parquet(f"{home}/rows")
        df, order = spark.read.parquet(f"{home}/rows"), [*order, TIE]
    n = n_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = F.monotonically_increasing_id()
    (df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(PLACE, number)
     .withColumns({RANGE: F.shiftright(PLACE, _PLACE_BITS).cast("int"),
                   PLACE: F.col(PLACE).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))})
     .drop(TIE).write.parquet(f"{home}/sorted"))
    return spark.read.parquet(f"{home}/sorted")


def _per_range(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """One row a range, of which there are as many as shuffle partitions."""
    return F.broadcast(spark.createDataFrame(rows, f"{RANGE} int, {columns}"))


def positions(df: DataFrame, order_cols: list[str], out_col: str = "pos", unique: bool = False) -> DataFrame:
    """Add each row's 0-based position in the order; one range exchange."""
    ranged = sorted_ranges(df, order_cols, unique)
    rows, before = [], 0
    for r in ranged.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n")).orderBy(RANGE).collect():
        rows.append((r[0], before))
        before += r[1]
    first = _per_range(df.sparkSession, rows, "_first bigint")
    return ranged.join(first, RANGE).select(*df.columns, (F.col("_first") + F.col(PLACE)).alias(out_col))


def group_positions(df: DataFrame, group_cols: list[str], order_cols: list[str] = (), out_col: str = "pos") -> DataFrame:
    """Add each row's 0-based position within its group (nulls are equal). A
    group of any size lies in as many ranges as it fills; what a range needs to
    know of the ranges before it is how many rows of its first group they hold."""
    group = F.struct(*group_cols)
    ranged = sorted_ranges(df.withColumn("_group", group), ["_group", *order_cols])
    spans = ranged.groupBy(RANGE, "_group").agg(F.count(F.lit(1)).alias("n"), F.min(PLACE).alias("lo"))
    key = F.sha2(F.to_json("_group", {"ignoreNullFields": "false"}), 256)
    span = F.struct(key.alias("key"), F.col("n"))
    ends = (spans.groupBy(RANGE).agg(F.min_by(span, "lo").alias("first"), F.max_by(span, "lo").alias("last"))
            .orderBy(RANGE).collect())
    rows, held = [], ("", 0)  # the group that the last range ended with, its rows so far
    for r in ends:
        earlier = held[1] if r["first"]["key"] == held[0] else 0
        rows.append((r[RANGE], earlier))
        held = (r["last"]["key"], r["last"]["n"] + (earlier if r["last"]["key"] == r["first"]["key"] else 0))
    in_range = Window.partitionBy(RANGE).orderBy("_group")
    start = F.rank().over(in_range) - 1  # rows of the range before the group
    placed = ranged.withColumn("_start", start).join(_per_range(df.sparkSession, rows, "_earlier bigint"), RANGE)
    here = F.col(PLACE) - F.col("_start") + F.when(F.col("_start") == 0, F.col("_earlier")).otherwise(0)
    return placed.select(*df.columns, here.cast("bigint").alias(out_col))


def with_successor(df: DataFrame, order_col: str, value_cols: list[str], prefix: str = "next_") -> DataFrame:
    """Add the values of the next row in ``order_col`` order (unique, a null
    first); the last row is followed by the first. A range's first row is also
    sent to the range before, so a window per range finds every successor."""
    ranged = sorted_ranges(df, [order_col], unique=True)
    found = [r[0] for r in ranged.select(RANGE).where(F.col(PLACE) == 0).orderBy(RANGE).collect()]
    before = _per_range(df.sparkSession, list(zip(found, found[-1:] + found[:-1])), "_before int")
    own = F.struct(F.lit(0).alias("edge"), F.col(RANGE).alias("to"))
    sent = F.struct(F.lit(1).alias("edge"), F.col("_before").alias("to"))
    placed = ranged.join(before, RANGE).withColumn(
        "_at", F.explode(F.when(F.col(PLACE) == 0, F.array(own, sent)).otherwise(F.array(own))))
    w = Window.partitionBy("_at.to").orderBy("_at.edge", PLACE)
    return (placed.withColumns({prefix + c: F.lead(c).over(w) for c in value_cols})
            .where(F.col("_at.edge") == 0).drop("_at", "_before", RANGE, PLACE))
