"""Epoch, rank and step planning (E1, F1-F9, G4) as a manifest table.

The manifest ``(epoch, rank, step, slot, pos, sample_id, copy)`` says which
sample feeds which slot of which micro-batch. It is built from a seeded
permutation rank (F1, distributed, see ``ranking``), wrap padding for
rank sharding (F6), fixed-size batches (F4) and a resume filter (E1/F7).

Ids may be null or repeated: ``copy`` numbers the samples of one id, so a slot
names exactly one sample whatever the ids are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import BASE_SEED
from .ranges import group_positions, positions
from .ranking import hex_prefix_bucket, join_on, rank_in_buckets

MAX_BROADCAST_OFFSETS = 1_000_000  # rows of (epoch, bucket, offset)
COPY = "copy"


def permutation_key(sample_id: Column, epoch: Column, seed: int = BASE_SEED, copy: Column | None = None) -> Column:
    """F1 key: md5 of ``'<seed + epoch>:<sample_id>'``, a null id being empty;
    a further copy of an id has ``':<copy>'`` behind it."""
    parts = [(F.lit(seed) + epoch).cast("string"), F.lit(":"), F.coalesce(sample_id.cast("string"), F.lit(""))]
    if copy is not None:
        parts.append(F.when(copy > 0, F.concat(F.lit(":"), copy.cast("string"))).otherwise(F.lit("")))
    return F.md5(F.concat(*parts))


def has_repeated_ids(df: DataFrame, id_col: str = "sample_id") -> bool:
    """One narrow aggregate over the ids, stopped at the first repeated one."""
    return bool(df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).limit(1).count())


def with_copies(df: DataFrame, id_col: str = "sample_id") -> DataFrame:
    """Add ``copy``: 0 for a lone id, 0 .. c-1 for the rows of an id that c
    rows have (a null id is one, too). Numbered in sorted ranges, so an id
    that a third of the rows have is numbered by many tasks."""
    if COPY in df.columns:
        return df
    if not has_repeated_ids(df, id_col):
        return df.withColumn(COPY, F.lit(0).cast("bigint"))
    return group_positions(df, [id_col], out_col=COPY)


def epoch_permutation(samples: DataFrame, epochs: int, seed: int = BASE_SEED,
                      id_col: str = "sample_id", hex_digits: int = 4,
                      shuffle: bool = True) -> DataFrame:
    """F1/F2 (shuffle) or F3 (natural order): ``(epoch, sample_id, pos)``.

    ``pos`` is 0-based within each epoch. Deterministic and independent of
    partitioning: the order is ``(md5 key, sample_id)``. Offsets are a table
    of at most ``epochs x 16**hex_digits`` rows, so broadcasting it is bounded.
    A column ``copy`` (see ``with_copies``) tells the samples of one id apart
    and is passed on.
    """
    each_epoch = F.explode(F.sequence(F.lit(0), F.lit(int(epochs) - 1)))
    named = [id_col, *([COPY] if COPY in samples.columns else [])]
    if not shuffle:
        return natural_order(samples.select(*named), id_col).withColumn("epoch", each_epoch)
    key = permutation_key(F.col(id_col), F.col("epoch"), seed, F.col(COPY) if COPY in named else None)
    keyed = samples.select(*named).withColumn("epoch", each_epoch).withColumn("_key", key)
    # Explicit broadcast only under a proven bound (~16 MB); above it AQE
    # decides from the run-time size.
    bounded = int(epochs) * 16 ** int(hex_digits) <= MAX_BROADCAST_OFFSETS
    out = rank_in_buckets(keyed, ["epoch"], hex_prefix_bucket(F.col("_key"), hex_digits),
                          [F.col("_key"), *[F.col(c) for c in named]], out_col="pos",
                          broadcast_offsets=True if bounded else None)
    return out.drop("_key")


def natural_order(ids: DataFrame, id_col: str = "sample_id") -> DataFrame:
    """position = rank of ``sample_id`` (same for every epoch). Each row
    has a position of its own, repeated and null ids (first) too."""
    unique = COPY in ids.columns
    return positions(ids, [id_col, *([COPY] if unique else [])], unique=unique)


def pad_to_world(perm: DataFrame, n: int, world: int) -> DataFrame:
    """F6 padding: positions ``n .. ceil(n/world)*world - 1`` repeat the
    sample at ``pos mod n``. Done in the same pass: each of the first
    ``extra`` rows also takes the positions ``pos + n, pos + 2n, ...``
    (a generator, no union that would recompute the permutation)."""
    total = math.ceil(n / world) * world if n else 0
    extra = total - n
    if extra <= 0:
        return perm
    positions = F.when(F.col("pos") < F.lit(extra),
                       F.sequence(F.col("pos"), F.lit(total - 1).cast("bigint"), F.lit(n).cast("bigint"))
                       ).otherwise(F.array(F.col("pos")))
    return perm.withColumn("pos", F.explode(positions))


def batch_columns(pos: Column, world: int, batch_size: int) -> list[Column]:
    """F4 + F6: rank, per-rank position, 1-based step and slot."""
    rank_pos = F.floor(pos / F.lit(world))
    return [(pos % F.lit(world)).cast("int").alias("rank"),
            rank_pos.cast("bigint").alias("rank_pos"),
            (F.floor(rank_pos / F.lit(batch_size)) + 1).cast("bigint").alias("step"),
            (rank_pos % F.lit(batch_size)).cast("int").alias("slot")]


def build_manifest(samples: DataFrame, epochs: int, world: int, batch_size: int,
                   seed: int = BASE_SEED, id_col: str = "sample_id",
                   n: int | None = None, shuffle: bool = True) -> DataFrame:
    """``(epoch, rank, step, slot, pos, sample_id, copy)`` for every epoch."""
    samples = with_copies(samples.select(id_col, *[c for c in (COPY,) if c in samples.columns]), id_col)
    perm = epoch_permutation(samples, epochs, seed, id_col, shuffle=shuffle)
    if world > 1:  # only rank padding needs the row count
        n = samples.count() if n is None else n  # A4, once per plan
        perm = pad_to_world(perm, n, world)
    padded = perm
    return padded.select("epoch", *batch_columns(F.col("pos"), world, batch_size),
                         "pos", id_col, COPY)


def step_sizes(spark: SparkSession, n: int, epochs: int, world: int, batch_size: int) -> DataFrame:
    """``(epoch, step, n_samples)`` over all ranks, by arithmetic alone: each
    rank has ``ceil(n / world)`` samples, and only its last batch is short."""
    per_rank = math.ceil(n / world) if n else 0
    iters = math.ceil(per_rank / batch_size)
    at = F.col("id")
    step = (at % F.lit(max(iters, 1)) + 1).cast("bigint")
    return spark.range(int(epochs) * iters).select(
        F.floor(at / F.lit(max(iters, 1))).cast("int").alias("epoch"), step.alias("step"),
        (F.least(F.lit(batch_size).cast("bigint"), F.lit(per_rank) - (step - 1) * F.lit(batch_size))
         * F.lit(world)).cast("bigint").alias("n_samples"))


def rescaled_step(saved_step: int, saved_world: int, current_world: int) -> int:
    """``step * saved // current`` when the world size changed."""
    if saved_world == current_world:
        return saved_step
    return saved_step * saved_world // current_world


def resume(manifest: DataFrame, start_epoch: int, skip_steps: int) -> DataFrame:
    """Drop epochs before ``start_epoch`` and the first ``skip_steps``
    full batches of it. The filter reaches Parquet statistics when the
    manifest is read back."""
    return manifest.where((F.col("epoch") > start_epoch) |
                          ((F.col("epoch") == start_epoch) & (F.col("step") > skip_steps)))


def resume_exact(perm: DataFrame, consumed: int, world: int, batch_size: int) -> DataFrame:
    """F7 alternative without repeats: drop exactly the ``consumed`` samples
    of the interrupted epoch (``saved_step * batch * saved_world``; ranks take
    positions round-robin, so they are the first ``consumed`` positions) and
    re-shard the rest for the new world size. Input: one epoch of
    ``(epoch, sample_id, pos)``; output: a manifest of the remainder."""
    rest = perm.where(F.col("pos") >= F.lit(int(consumed))) \
        .withColumn("pos", F.col("pos") - F.lit(int(consumed)))
    return rest.select("epoch", *batch_columns(F.col("pos"), world, batch_size), "pos", *[
        c for c in perm.columns if c not in ("epoch", "pos")])


def consumed_samples(saved_step: int, batch_size: int, saved_world: int) -> int:
    """Samples of the epoch already trained on when progress was saved."""
    return int(saved_step) * int(batch_size) * int(saved_world)


def batches_per_rank(n: int, world: int, batch_size: int, skip: int = 0) -> int:
    """``max(0, ceil(per_rank / bs) - skip)``."""
    per_rank = math.ceil(n / world) if n else 0
    return max(0, math.ceil(per_rank / batch_size) - skip)


def fetch_batches(manifest: DataFrame, encoded: DataFrame, id_col: str = "sample_id") -> DataFrame:
    """Attach to each planned slot exactly one encoded sample.

    The join is on the id (null ids are equal) and the copy number. Lone ids
    join as they are; if ids repeat, the encoded rows of one id are numbered
    as the plan's are, so each of them is delivered once an epoch. A plan
    without copy numbers is refused then: it can't say which is meant.
    """
    if not has_repeated_ids(encoded, id_col):
        return join_on(manifest.drop(COPY), encoded, [id_col])
    if COPY not in manifest.columns:
        raise ValueError(f"{id_col} repeats, but the plan has no column {COPY}")
    return join_on(manifest, with_copies(encoded, id_col), [id_col, COPY]).drop(COPY)


def delivery_parts(manifest: DataFrame, n_parts: int) -> tuple[DataFrame, int]:
    """``(epoch, rank, _steps, _lo, _base)``: how the plan is cut into about
    ``n_parts`` parts of consecutive steps, and their number. One row for each
    epoch and rank, from the plan's narrow columns alone."""
    spans = (manifest.groupBy("epoch", "rank").agg(F.min("step").alias("lo"), F.max("step").alias("hi"))
             .orderBy("epoch", "rank").collect())
    total = sum(r["hi"] - r["lo"] + 1 for r in spans)
    steps = max(1, math.ceil(total / max(1, n_parts)))
    rows, base = [], 0
    for r in spans:
        rows.append((r["epoch"], r["rank"], steps, r["lo"], base))
        base += (r["hi"] - r["lo"]) // steps + 1
    table = manifest.sparkSession.createDataFrame(rows, "epoch int, rank int, _steps bigint, _lo bigint, _base int")
    return F.broadcast(table) if len(rows) <= MAX_BROADCAST_OFFSETS else table, base


def write_training_shards(manifest: DataFrame, encoded: DataFrame, path: str,
                          id_col: str = "sample_id", n_parts: int | None = None,
                          max_records_per_file: int = 100_000) -> None:
    """A5: encoded samples in delivery order, one folder per (epoch, rank).

    A row's partition follows from the plan: some consecutive steps of one
    epoch and rank make a part, numbered in order. So the encoded rows are
    joined once and sent straight to their part (no sampling of bounds), a
    rank's epoch is split over many tasks and files, and parts hold equal
    numbers of batches. Rows inside a file are sorted by step and slot;
    reading a folder in file-name order replays the batches.
    """
    # Default: the session's shuffle partitions (sized for the cluster).
    n_parts = n_parts or int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts, n = delivery_parts(manifest, n_parts)
    part = F.col("_base") + F.floor((F.col("step") - F.col("_lo")) / F.col("_steps")).cast("int")
    placed = manifest.join(parts, ["epoch", "rank"]).withColumn("_part", part).drop("_steps", "_lo", "_base")
    rows = fetch_batches(placed, encoded, id_col)
    (rows.repartitionById(max(1, n), "_part").drop("_part")
     .sortWithinPartitions("epoch", "rank", "step", "slot")
     .write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
     .partitionBy("epoch", "rank").parquet(path))
