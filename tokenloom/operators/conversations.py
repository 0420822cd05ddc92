"""Record building from a turns table (K1, K2).

K1 assembles one message array per conversation. The output is one row per
conversation by definition; ``collect_list`` is partially aggregated on the
map side, so a long conversation costs one combined buffer, not a shuffle
of single rows into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.chat import messages_from_turns
from ..plans.ranges import with_successor
from ..plans.ranking import grouped_running_total

KNOWN_ROLES = ("user", "system", "assistant", "tool")
# Fewest tokens that any rendered user/system/assistant/tool message takes:
# one with any vocabulary; with the byte tokenizer
# "<|im_start|>user\n<|im_end|>\n" = 1 + 5 + 1 + 1.
MIN_MESSAGE_TOKENS = 1
BYTE_MESSAGE_TOKENS = 8


def within_budget(turns: DataFrame, max_tokens: int, id_col: str = "conv_id",
                  min_message_tokens: int = MIN_MESSAGE_TOKENS) -> DataFrame:
    """Drop the turns that start beyond ``max_tokens`` in every rendering.

    A turn preceded by ``k`` known-role messages starts at token
    ``>= k * min_message_tokens``; once that reaches the budget the turn and
    everything after it are cut off, and removing this suffix only changes
    text that lies past the cut. The count ``k`` is a distributed running
    total, so a conversation of any length is split over many tasks and the
    collected message array stays bounded by the budget.
    The default holds for every vocabulary; a larger bound drops more rows
    early and is only right if the tokenizer in use guarantees it
    (``BYTE_MESSAGE_TOKENS`` for the byte tokenizer).
    """
    limit = -(-int(max_tokens) // int(min_message_tokens))
    known = F.col("role").isin(*KNOWN_ROLES).cast("bigint")
    counted = grouped_running_total(turns, [id_col], "turn", known, "_k", inclusive=False)
    return counted.where(F.col("_k") < limit).drop("_k")


def chat_records(turns: DataFrame, id_col: str = "conv_id", max_tokens: int | None = None,
                 min_message_tokens: int = MIN_MESSAGE_TOKENS) -> DataFrame:
    """K1: ``(conv_id, turn, role, content)`` -> ``(conv_id, messages)``.

    With ``max_tokens`` (encoders), turns past the token budget are dropped
    before collecting; without it (rendering), the whole conversation is kept.
    """
    if max_tokens is not None:
        turns = within_budget(turns, max_tokens, id_col, min_message_tokens)
    return (turns.groupBy(id_col)
            .agg(F.collect_list(F.struct("turn", "role", "content")).alias("_t"))
            .select(id_col, messages_from_turns(F.col("_t")).alias("messages")))


def preference_pairs(turns: DataFrame, id_col: str = "conv_id",
                     max_tokens: int | None = None,
                     min_message_tokens: int = MIN_MESSAGE_TOKENS) -> DataFrame:
    """K2: ``(pair_id, chosen, rejected)``.

    Conversations with an assistant turn are cut after their last assistant
    turn; ``rejected`` swaps that turn's text for the one of the next such
    conversation in id order (the last wraps to the first). The successor is
    found in a table sorted in ranges of ids, never by a window over all
    conversations. Each conversation is collected once. The turns of a null id
    are one conversation, which is the first in id order.
    """
    turns = turns.withColumn("_id", F.struct(id_col))  # equal for null ids, too
    last = (turns.where(F.col("role") == "assistant")
            .groupBy("_id")
            .agg(F.max_by(F.struct("turn", "content"), "turn").alias("_last"))
            .select(F.col("_id")[id_col].alias(id_col), F.col("_last.turn").alias("cut_turn"),
                    F.col("_last.content").alias("last_text")))
    pairs = with_successor(last, id_col, ["last_text"]).select(
        F.struct(id_col).alias("_id"), "cut_turn", F.col("next_last_text").alias("next_text"))
    if max_tokens is not None:
        # A turn's budget count depends only on earlier turns, so pruning
        # before the cut gives the same rows and avoids recomputing the join.
        turns = within_budget(turns, max_tokens, "_id", min_message_tokens)
    entries = turns.groupBy("_id").agg(F.collect_list(F.struct("turn", "role", "content")).alias("_t"))
    kept = F.filter("_t", lambda x: x["turn"] <= F.col("cut_turn"))
    swapped = F.transform("_c", lambda x: F.struct(
        x["turn"].alias("turn"), x["role"].alias("role"),
        F.when(x["turn"] == F.col("cut_turn"), F.col("next_text")).otherwise(x["content"]).alias("content")))
    return (entries.join(pairs, "_id").withColumn("_c", kept)
            .select(F.col("_id")[id_col].alias("pair_id"),
                    messages_from_turns(F.col("_c")).alias("chosen"),
                    messages_from_turns(swapped).alias("rejected")))
