"""Per-step schedule columns (E2-E4, F8, F9) as closed forms.

All columns are arithmetic on ``(epoch, step, iters)``, so a calendar of
any length needs no window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def cosine_lr(current: Column, total: Column, lr: float) -> Column:
    """``lr/10 + 0.5*lr*(1 + cos(pi*current/total))``."""
    return F.lit(lr / 10) + F.lit(0.5 * lr) * (F.lit(1.0) + F.cos(F.lit(math.pi) * current / total))


def step_lr(epoch: Column, step: Column, iters: Column, epochs: int, lr: float) -> Column:
    return cosine_lr(epoch * iters + step, F.lit(epochs) * iters, lr)


def is_log_step(step: Column, iters: Column, interval: int) -> Column:
    """``step % interval == 0 or step == iters - 1`` (kept as written)."""
    return ((step % F.lit(interval)) == 0) | (step == iters - 1)


def is_save_step(step: Column, iters: Column, interval: int) -> Column:
    """Same test with the save interval."""
    return is_log_step(step, iters, interval)


def is_update_step(step: Column, accumulation: int) -> Column:
    """``(step + 1) % accumulation == 0``."""
    return ((step + 1) % F.lit(accumulation)) == 0


def update_group(epoch: Column, step: Column, iters: Column, accumulation: int) -> Column:
    """F8: the weight update (1-based) that a micro-step's gradient goes into:
    one more than the updates strictly before the step. Micro-steps after an
    epoch's last update go into the first one of the next epoch."""
    a, base = F.lit(accumulation), F.lit(1 // accumulation)
    per_epoch = F.floor((iters + 1) / a) - base
    return (epoch * per_epoch + F.floor(step / a) - base + 1).cast("bigint")


def update_number(epoch: Column, step: Column, iters: Column, accumulation: int) -> Column:
    """F8: how many weight updates happened up to and including this step.

    Updates in steps ``1..s`` of an epoch are ``floor((s+1)/a) - floor(1/a)``.
    """
    a = F.lit(accumulation)
    base = F.lit(1 // accumulation)
    per_epoch = F.floor((iters + 1) / a) - base
    return (epoch * per_epoch + F.floor((step + 1) / a) - base).cast("bigint")
