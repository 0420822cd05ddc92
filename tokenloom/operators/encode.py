"""Whole-sample encoders C1-C3: narrow projections, no shuffle.

Each encoder is one ``select`` that runs in the scan stage (with a user
vocabulary, one Arrow ``mapInArrow`` step before it); encoding once and
writing Parquet replaces the per-access encoding of every epoch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed import DPO_MAX_LENGTH, PRETRAIN_MAX_LENGTH, SFT_MAX_LENGTH
from ..functions.chat import render_chat
from ..functions.segments import marker_segments, segment_labels, segment_mask
from ..functions.spans import span_labels, span_mask
from ..functions.tokens import (coerce_text, encode_text, pad_right, pretrain_pair, shift_inputs, shift_targets,
                                token_prefix, truncate)
from ..functions.util import let
from ..fixed import ASSISTANT_END_IDS, ASSISTANT_END_TEXT, ASSISTANT_START_IDS, ASSISTANT_START_TEXT
from .vocab import marker_ids, tokenize_column


def _markers(tokenizer_factory) -> tuple[list[int], list[int]]:
    if tokenizer_factory is None:
        return ASSISTANT_START_IDS, ASSISTANT_END_IDS
    return (marker_ids(tokenizer_factory, ASSISTANT_START_TEXT),
            marker_ids(tokenizer_factory, ASSISTANT_END_TEXT))


def _tokens(df: DataFrame, text: F.Column, limit: int, name: str,
            tokenizer_factory) -> tuple[DataFrame, F.Column]:
    """Native byte ids, or the user's vocabulary through Arrow batches."""
    if tokenizer_factory is None:
        return df, encode_text(text, limit)
    src = df.withColumn(f"_txt_{name}", text)
    out = tokenize_column(src, f"_txt_{name}", tokenizer_factory, f"_tok_{name}", limit)
    return out.drop(f"_txt_{name}"), F.col(f"_tok_{name}")


def encode_pretrain(df: DataFrame, text_col: str = "text", id_col: str = "sample_id",
                    max_length: int = PRETRAIN_MAX_LENGTH, tokenizer_factory=None) -> DataFrame:
    """``(id, input_ids, labels)``, both of length ``max_length``."""
    L = int(max_length)
    df, toks = _tokens(df, coerce_text(F.col(text_col)), L - 2, "text", tokenizer_factory)
    return df.select(F.col(id_col), pretrain_pair(toks, L).alias("_s")).select(id_col, "_s.input_ids", "_s.labels")


def prompt_ids(prompt: F.Column, max_length: int) -> F.Column:
    """B3 + B5 + B7: tokenize, cut to ``max_length``, pad to it."""
    return pad_right(encode_text(prompt, int(max_length)), int(max_length))


def encode_sft(df: DataFrame, id_col: str = "sample_id", messages_col: str = "messages",
               tools_col: str | None = "tools", max_length: int = SFT_MAX_LENGTH,
               tokenizer_factory=None) -> DataFrame:
    """Render (with tools) -> ids -> span labels."""
    L = int(max_length)
    tools = F.col(tools_col) if tools_col else None
    prompt = render_chat(F.col(messages_col), tools)
    if tokenizer_factory is None:  # runs from the text, expanded once
        pair = let(token_prefix(prompt, L), lambda t: let(pad_right(truncate(encode_text(t), L), L), lambda a: F.struct(
            a.alias("input_ids"), segment_labels(marker_segments(t, L), a).alias("labels"))))
    else:
        start, end = _markers(tokenizer_factory)
        df, toks = _tokens(df, prompt, L, "prompt", tokenizer_factory)
        pair = let(pad_right(toks, L), lambda a: F.struct(
            a.alias("input_ids"), span_labels(a, L, start, end).alias("labels")))
    return df.select(F.col(id_col), pair.alias("_s")).select(id_col, "_s.input_ids", "_s.labels")


def encode_dpo(df: DataFrame, id_col: str = "pair_id", chosen_col: str = "chosen",
               rejected_col: str = "rejected", max_length: int = DPO_MAX_LENGTH,
               tokenizer_factory=None) -> DataFrame:
    """Both sides rendered without tools, masked, shifted to ``L - 1``."""
    L = int(max_length)

    def shifted(ids: F.Column, mask: F.Column, name: str) -> F.Column:
        return let(ids, lambda a: F.struct(
            shift_inputs(a, L).alias(f"x_{name}"), shift_targets(a, L).alias(f"y_{name}"),
            shift_targets(mask, L).alias(f"mask_{name}")))

    def from_text(messages: str, name: str) -> F.Column:
        return let(token_prefix(render_chat(F.col(messages)), L), lambda t: shifted(
            pad_right(truncate(encode_text(t), L), L), segment_mask(marker_segments(t, L)), name))

    def from_ids(toks: F.Column, name: str) -> F.Column:
        return let(pad_right(toks, L), lambda a: shifted(a, span_mask(a, L, start, end), name))

    if tokenizer_factory is None:
        chosen, rejected = from_text(chosen_col, "chosen"), from_text(rejected_col, "rejected")
    else:
        start, end = _markers(tokenizer_factory)
        df, tc = _tokens(df, render_chat(F.col(chosen_col)), L, "chosen", tokenizer_factory)
        df, tr = _tokens(df, render_chat(F.col(rejected_col)), L, "rejected", tokenizer_factory)
        chosen, rejected = from_ids(tc, "chosen"), from_ids(tr, "rejected")
    return (df.select(F.col(id_col), chosen.alias("_c"), rejected.alias("_r"))
            .select(id_col, "_c.*", "_r.*"))
