"""Epoch permutations with random access.

A keyed Feistel network on the positions ``0 .. n-1``: which sample stands at
a position, and at which position a sample stands, is arithmetic on the row
itself. The steps a to b of a rank are found without sorting or numbering the
epoch, a resumed run starts at any step, and all ranks agree from ``(n, seed,
epoch)`` alone.

The domain is ``a x b`` with ``a = ceil(sqrt(n))`` and ``b = ceil(n / a)``: each
half-round adds a hash of one digit to the other, modulo its size, so every
round is a permutation whatever the hash. Fewer than ``a`` results lie at or
beyond ``n``; those are mapped on until they don't (cycle walking), which
keeps it a permutation of ``0 .. n-1``. All numbers fit in 63 bits for n up
to 10^18.

Samples are named by dense ordinals (``with_ordinals``, made once a table).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import BASE_SEED
from ..functions.util import let
from .epochs import COPY, batch_columns, with_copies
from .ranges import positions

ROUNDS = 3  # of two halves each
PRIME = 2147483647
WALK = 24  # maps at most; never reached for n beyond 576, where it would take n^-12
MAX_BROADCAST_SLOTS = 1_000_000


def sides(n: int) -> tuple[int, int]:
    """The two digits' sizes."""
    a = math.isqrt(max(n, 1) - 1) + 1
    return a, -(-max(n, 1) // a)


def _div(x: Column, y: Column) -> Column:
    """Whole quotient of non-negative numbers, exact beyond 2^53."""
    return ((x - x % y).cast("decimal(20,0)") / y.cast("decimal(20,0)")).cast("bigint")


def _mixed(x: Column, key: Column) -> Column:
    """Integer hash below ``PRIME`` of a digit and a key."""
    def spread(t: Column, bits: int) -> Column:
        return t.bitwiseXOR(F.shiftright(t, bits))

    t = spread((x * F.lit(2654435) + key) % F.lit(PRIME), 15)
    return spread((t * F.lit(48271) + F.lit(11)) % F.lit(PRIME), 13)


def _keys(epoch: Column, seed: int) -> Column:
    """``array<struct(left, right)>`` of the rounds' keys, in their order."""
    base = (F.lit(seed).cast("bigint") + epoch) * F.lit(69621) % F.lit(PRIME)

    def key(i: int) -> Column:
        return _mixed(F.lit(i + 1).cast("bigint"), base)

    return F.array(*[F.struct(key(2 * i).alias("left"), key(2 * i + 1).alias("right")) for i in range(ROUNDS)])


def _walked(start: Column, n: int, step) -> Column:
    """``step`` applied once, then until the value is below ``n``."""
    once = let(start.cast("bigint"), step)
    most = min(WALK, sides(n)[0])
    end = F.aggregate(F.sequence(F.lit(1), F.lit(most)), once, lambda x, _: F.when(x < n, x).otherwise(step(x)))
    failed = F.raise_error(F.lit("a permutation's cycle is too long")).cast("bigint")
    return let(end, lambda x: F.when(x < n, x).otherwise(failed))


def ordinal_at(pos: Column, epoch: Column, n: int, seed: int = BASE_SEED) -> Column:
    """Ordinal of the sample at a position of an epoch."""
    a, b = (F.lit(x).cast("bigint") for x in sides(n))

    def step(x: Column) -> Column:
        def turn(acc: Column, k: Column) -> Column:
            left = (acc["left"] + _mixed(acc["right"], k["left"])) % a
            return let(left, lambda y: F.struct(y.alias("left"), (
                (acc["right"] + _mixed(y, k["right"])) % b).alias("right")))

        first = F.struct(_div(x, b).alias("left"), (x % b).alias("right"))
        return F.aggregate(_keys(epoch, seed), first, turn, lambda acc: acc["left"] * b + acc["right"])

    return _walked(pos, n, step)


def position_of(ordinal: Column, epoch: Column, n: int, seed: int = BASE_SEED) -> Column:
    """Position at which a sample stands in an epoch: the inverse."""
    a, b = (F.lit(x).cast("bigint") for x in sides(n))

    def step(x: Column) -> Column:
        def turn(acc: Column, k: Column) -> Column:
            right = F.pmod(acc["right"] - _mixed(acc["left"], k["right"]), b)
            return let(right, lambda y: F.struct(F.pmod(
                acc["left"] - _mixed(y, k["left"]), a).alias("left"), y.alias("right")))

        first = F.struct(_div(x, b).alias("left"), (x % b).alias("right"))
        return F.aggregate(F.reverse(_keys(epoch, seed)), first, turn, lambda acc: acc["left"] * b + acc["right"])

    return _walked(ordinal, n, step)


def with_ordinals(samples: DataFrame, id_col: str = "sample_id") -> DataFrame:
    """Add ``ordinal``, dense from 0 in id order (nulls first; copies of an id
    follow each other). Store it with the samples."""
    named = with_copies(samples, id_col)
    return positions(named, [id_col, COPY], out_col="ordinal", unique=True)


def rank_slots(spark: SparkSession, n: int, epochs: list[int], world: int, batch_size: int, rank: int,
               first_step: int, last_step: int, seed: int = BASE_SEED) -> DataFrame:
    """``(epoch, rank, step, slot, pos, ordinal)`` of the steps
    ``first_step .. last_step`` (from 1) of a rank, by arithmetic alone.
    Padding to a multiple of ``world`` wraps around as in ``pad_to_world``."""
    per_rank = math.ceil(n / world) if n else 0
    lo, hi = (first_step - 1) * batch_size, min(last_step * batch_size, per_rank)
    count = max(0, hi - lo)
    at = F.col("id") % F.lit(max(count, 1)) + F.lit(lo)
    epoch = F.get(F.array(*[F.lit(int(e)) for e in epochs]), F.floor(F.col("id") / F.lit(max(count, 1))).cast("int"))
    placed = spark.range(len(epochs) * count).select(epoch.alias("epoch"), (at * world + rank).alias("pos"))
    return placed.select("epoch", *[c for c in batch_columns(F.col("pos"), world, batch_size)], "pos",
                         ordinal_at(F.col("pos") % F.lit(max(n, 1)), F.col("epoch"), n, seed).alias("ordinal")
                         ).drop("rank_pos")


def fetch_steps(slots: DataFrame, samples: DataFrame, n_slots: int) -> DataFrame:
    """The samples of planned slots, by ordinal: slots are broadcast up to
    ``MAX_BROADCAST_SLOTS`` of them, so the samples stay in place."""
    slots = F.broadcast(slots) if n_slots <= MAX_BROADCAST_SLOTS else slots
    return samples.join(slots, "ordinal")


def with_positions(samples: DataFrame, epochs: list[int], n: int, world: int, batch_size: int,
                   seed: int = BASE_SEED) -> DataFrame:
    """Where each sample stands in each epoch: adds ``epoch, rank, step, slot,
    pos`` in place (without the wrap padding)."""
    each = samples.withColumn("epoch", F.explode(F.array(*[F.lit(int(e)) for e in epochs])))
    placed = each.withColumn("pos", position_of(F.col("ordinal"), F.col("epoch"), n, seed))
    return placed.select(*samples.columns, "epoch", *batch_columns(F.col("pos"), world, batch_size),
                         "pos").drop("rank_pos")
