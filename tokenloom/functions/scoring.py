"""Token-level scoring expressions (H1, H6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .util import let


def log_softmax_at(logits: Column, index: Column) -> Column:
    """H1: ``log_softmax(logits)[index]``, stable (max subtracted).

    Runs per row in the scan stage, so the logits array is never shuffled.
    An out-of-range index gives NULL.
    """
    def body(a: Column) -> Column:
        return let(F.array_max(a), lambda m: F.get(a, index) - m - F.log(
            F.aggregate(a, F.lit(0.0).cast("double"), lambda acc, x: acc + F.exp(x - m))))
    return let(logits, body)


LOGIT_STATE = "struct<top:double,total:double,picked:double>"
_NO_MASS = float("-inf")


def logit_state(logits: Column, index: Column, first: Column) -> Column:
    """H1 over a slice of the vocabulary that begins at id ``first``: its
    largest logit, the sum of ``exp(x - largest)`` and the logit of ``index``
    (null in all slices but the one that has it). States of the slices of one
    token merge in any order (``merged_states``)."""
    def body(a: Column) -> Column:
        def state(top: Column) -> Column:
            total = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
            at = index - first
            return F.struct(F.coalesce(top.cast("double"), F.lit(_NO_MASS)).alias("top"),
                            F.when(top > F.lit(_NO_MASS), total).otherwise(F.lit(0.0)).alias("total"),
                            F.when(at >= 0, F.get(a, at)).cast("double").alias("picked"))
        return let(F.array_max(a), state)
    return let(F.transform(logits, lambda x: x.cast("double")), body).cast(LOGIT_STATE)


def merged_states(states: Column) -> Column:
    """One state from an array of states."""
    def body(top: Column) -> Column:
        total = F.aggregate(states, F.lit(0.0), lambda acc, x: acc + F.when(
            x["top"] > F.lit(_NO_MASS), x["total"] * F.exp(x["top"] - top)).otherwise(F.lit(0.0)))
        picked = F.array_max(F.transform(states, lambda x: x["picked"]))
        return F.struct(top.alias("top"), total.alias("total"), picked.alias("picked"))
    return let(F.array_max(F.transform(states, lambda x: x["top"])), body).cast(LOGIT_STATE)


def state_logprob(state: Column) -> Column:
    """Log-probability that a token's merged state gives; null without the label."""
    return state["picked"] - state["top"] - F.log(state["total"])


def softplus(x: Column) -> Column:
    """``log(1 + exp(x))`` without overflow."""
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def neg_log_sigmoid(z: Column) -> Column:
    """H6 per pair: ``-logsigmoid(z) = softplus(-z)``."""
    return softplus(-z)
