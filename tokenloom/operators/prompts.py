"""Prompt building and bulk generation.

I1 gives each user turn the ``history`` messages before it. Instead of a
window over a whole conversation, turns are grouped in blocks of
``history`` turns (each turn also joins the next block), so a group holds
at most ``2 x history`` rows and a very long conversation is spread over
many tasks.

J3 is the only Python step: a user-supplied predictor runs in
``mapInArrow`` on slices of Arrow batches, bounded by their prompts' ids, and
is built once per Python worker.
"""

from __future__ import annotations

from typing import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import BYTE_OFFSET, IM_START, MODEL_MAX_LENGTH
from ..functions.chat import messages_from_turns, render_chat
from ..functions.tokens import encode_text, strip_specials
from ..functions.util import bounded_slices, worker_instance
from ..plans.ranges import group_positions
from ..plans.ranking import grouped_rank
from .vocab import detokenize_column


def history_messages(turns: DataFrame, history: int, id_col: str = "conv_id") -> DataFrame:
    """``(conv_id, turn, messages)`` for every user turn.

    ``messages`` = the ``history`` turns before it (fewer at the start; 0 =
    none) followed by the user message itself.

    "Before" goes by position in the conversation, so gaps in the turn
    numbers make no difference (equal numbers are ordered by role and text).

    Turns are cut into blocks of ``B = max(history, 1)`` positions; each is
    sent to its own block and the next one, so a group holds at most ``2B``
    rows and every user turn finds its whole window in its own block's
    group. The shuffle carries each turn twice, whatever the history length,
    and a long conversation is spread over many groups.
    """
    h = max(int(history), 0)
    block_size = max(h, 1)
    placed = grouped_rank(turns, [id_col], "turn", tiebreak=["role", "content"], out_col="_p")
    blk = F.floor(F.col("_p") / F.lit(block_size)).cast("bigint")
    spread = placed.withColumn("_b", F.explode(F.array(blk, blk + 1)))
    # The position comes first, so sorting goes by it.
    grouped = (spread.groupBy(id_col, "_b")
               .agg(F.collect_list(F.struct("_p", "role", "content", "turn")).alias("_t")))
    own = lambda x: (F.floor(x["_p"] / F.lit(block_size)) == F.col("_b")) & (x["role"] == "user")
    targets = grouped.select(id_col, "_t", F.explode(F.filter("_t", own)).alias("_u"))
    window = F.filter("_t", lambda x: (x["_p"] >= F.col("_u._p") - F.lit(h)) & (x["_p"] <= F.col("_u._p")))
    return targets.select(id_col, F.col("_u.turn").alias("turn"),
                          messages_from_turns(window).alias("messages"))


def generation_prompt(messages: Column, mode: str = "chat") -> Column:
    """J1 for a message array: chat template with the generation tail.

    ``mode='reason'`` passes ``enable_thinking=True`` (no change in text).
    """
    return render_chat(messages, add_generation_prompt=True,
                       enable_thinking=True if mode == "reason" else None)


def pretrain_prompt(text: Column) -> Column:
    """J1, pretrain weights: bos string + raw prompt."""
    return F.concat(F.lit(IM_START), text)


def prompt_ids(prompt: Column, max_length: int = MODEL_MAX_LENGTH) -> Column:
    """Tokenize with truncation at the model limit."""
    return encode_text(prompt, int(max_length))


def generate(prompts: DataFrame, predictor_factory: Callable, ids_col: str = "prompt_ids",
             out_col: str = "output_ids") -> DataFrame:
    """Run the user's predictor over slices of Arrow batches.

    ``predictor_factory()`` returns a callable ``list[list[int]] ->
    list[list[int]]`` giving, per prompt, prompt ids followed by new ids.
    """
    from pyspark.sql.types import ArrayType, IntegerType, StructType
    schema = StructType(list(prompts.schema.fields)).add(out_col, ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = worker_instance(predictor_factory)
        for whole in batches:
            for b in bounded_slices(whole, ids_col):
                out = predict([list(x) for x in b.column(ids_col).to_pylist()])
                yield b.append_column(out_col, pa.array(out, type=pa.list_(pa.int32())))

    return prompts.mapInArrow(run, schema)


def decode_bytes(ids: Column) -> Column:
    """Byte ids -> text (invalid UTF-8 becomes U+FFFD); other ids fail."""
    def as_hex(t: Column) -> Column:
        byte = t - F.lit(BYTE_OFFSET)
        return F.when((byte >= 0) & (byte < 256), F.lpad(F.hex(byte), 2, "0")).otherwise(
            F.raise_error(F.concat(F.lit("not an id of the byte tokenizer: "), t.cast("string"))).cast("string"))

    hexed = F.array_join(F.transform(ids, as_hex), "")
    return F.decode(F.unhex(hexed), "UTF-8")


def reply_text(prompt_ids_col: Column, output_ids: Column,
               decode: Callable[[Column], Column] = decode_bytes) -> Column:
    """Drop the prompt part and special ids, decode the rest. ``decode``
    turns an id array into text; the default is the byte tokenizer's."""
    new = F.slice(output_ids, F.size(prompt_ids_col) + 1, F.greatest(F.size(output_ids), F.lit(1)))
    return decode(strip_specials(new))


def append_replies(turns: DataFrame, replies: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """``turns`` with each reply as an assistant turn right behind the
    turn that it answers. Turn numbers are doubled, so a reply to turn ``t``
    is ``2 t + 1`` and collides with no other turn, also in mid-conversation;
    replies to the same turn would."""
    old = turns.select(id_col, (F.col("turn") * 2).alias("turn"), "role", "content")
    new = replies.select(id_col, (F.col("turn") * 2 + 1).alias("turn"),
                         F.lit("assistant").alias("role"), F.col("reply").alias("content"))
    return old.unionByName(new)


def insert_replies(turns: DataFrame, replies: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """J5 for conversations that go on: each reply stands right behind the
    turn that it answers, and turns are numbered 0 .. n-1 anew, so the result
    is a turns table as before and takes part in the next round.

    A turn's new number is its position among the old turns and the replies,
    from prefix sums over sorted ranges (``plans.ranges``): a conversation
    that holds a third of all turns is numbered by many tasks. Equal turn
    numbers are ordered by role and content; replies to equal turns too.
    """
    old = turns.select(id_col, "turn", F.lit(0).alias("_kind"), "role", "content")
    new = replies.select(id_col, "turn", F.lit(1).alias("_kind"), F.lit("assistant").alias("role"),
                         F.col("reply").alias("content"))
    digest = F.md5(F.coalesce(F.col("content"), F.lit("")))  # a narrow key of the ranges' bounds
    placed = group_positions(old.unionByName(new).withColumn("_digest", digest), [id_col],
                             ["turn", "_kind", "role", "_digest"], out_col="_at")
    return placed.select(id_col, F.col("_at").alias("turn"), "role", "content")


def decode_replies(generated: DataFrame, tokenizer_factory: Callable, prompt_col: str = "prompt_ids",
                   ids_col: str = "output_ids", out_col: str = "reply") -> DataFrame:
    """J4 with the user's vocabulary: the ids behind the prompt, cut off
    natively, become text in Arrow batches; its special ids are left out."""
    new = F.slice(F.col(ids_col), F.size(prompt_col) + 1, F.greatest(F.size(ids_col), F.lit(1)))
    return detokenize_column(generated.withColumn("_new", new), "_new", tokenizer_factory, out_col).drop("_new")


def repeat_predictor_factory():
    """Stand-in model for any vocabulary: repeats the prompt's ids."""
    return lambda batch: [[*ids, *ids] for ids in batch]


def echo_predictor_factory():
    """Stand-in model for tests and the bulk query: repeats the last user
    message of the prompt, framed by specials and followed by pads."""
    import numpy as np

    user_head = [1] + [b + BYTE_OFFSET for b in b"user\n"]

    def predict(batch: list[list[int]]) -> list[list[int]]:
        out = []
        for ids in batch:
            a = np.asarray(ids, dtype=np.int64)
            k = len(user_head)
            starts = [i for i in np.flatnonzero(a == 1) if list(a[i:i + k]) == user_head]
            reply: list[int] = []
            if starts:
                body = a[starts[-1] + k:]
                ends = np.flatnonzero(body == 2)
                reply = body[: ends[0] if len(ends) else len(body)].tolist()
            out.append(list(ids) + [1] + reply + [2, 0, 0])
        return out

    return predict
