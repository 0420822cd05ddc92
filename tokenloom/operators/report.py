"""K3: length and truncation report for choosing ``max_seq_len``.

Counts come from whole texts (exact token count without building arrays);
everything else is a partial aggregate per group. The median is exact: its
state holds one counter per distinct length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tokens import coerce_text, token_count

BLOCK = 1024  # turns of a conversation that one window group holds


def length_report(records: DataFrame, group_cols: list[str], max_length: int,
                  text_col: str = "text", reserved: int = 2) -> DataFrame:
    """Per group: documents, token total/avg/max/median, truncated rows and
    the share of padding in fixed-length samples of ``max_length``
    (``reserved`` ids are added per sample: bos and eos for pretraining)."""
    L = int(max_length)
    n = token_count(coerce_text(F.col(text_col)))
    kept = F.least(n, F.lit(L - reserved)) + F.lit(reserved)
    t = records.select(*group_cols, n.alias("n_tokens"), kept.alias("kept"))
    return t.groupBy(*group_cols).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_docs"),
        F.sum("n_tokens").cast("bigint").alias("total_tokens"),
        F.avg("n_tokens").alias("avg_tokens"),
        F.max("n_tokens").cast("bigint").alias("max_tokens"),
        F.expr("percentile_disc(0.5) within group (order by n_tokens)").cast("bigint").alias("median_tokens"),
        F.sum((F.col("n_tokens") > L - reserved).cast("bigint")).alias("n_truncated"),
        (F.sum(F.lit(L) - F.col("kept")) / (F.count(F.lit(1)) * F.lit(L))).alias("pad_share"))


def conversation_token_counts(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Token count of every whole rendered conversation, without assembling it.

    Each turn is rendered on its own row (head on the first, tool-block
    edges from the neighbours' roles, found in blocks of positions) and the
    counts are summed per conversation. Byte-token counts add up across
    messages because every rendered message is self-contained and no
    special string can form across a message boundary.
    """
    from ..functions.chat import TOOL_CALL_TYPE, render_head, render_message
    from ..plans.ranking import grouped_rank
    ranked = grouped_rank(turns, [id_col], "turn", out_col="_i")
    # Blocks of positions; the rows at a block's ends are also sent to the
    # block beyond, so a window per block sees every neighbour.
    i, block = F.col("_i"), F.floor(F.col("_i") / F.lit(BLOCK))
    spread = ranked.withColumn("_b", F.explode(F.array_compact(F.array(
        block, F.when(i % BLOCK == 0, block - 1), F.when(i % BLOCK == BLOCK - 1, block + 1)))))
    w = Window.partitionBy(id_col, "_b").orderBy("_i")
    rows = (spread.withColumns({"_prev": F.lag("role").over(w), "_next": F.lead("role").over(w)})
            .where(block == F.col("_b")))
    first = F.col("_i") == 0
    is_tool = lambda c: F.coalesce(F.col(c) == F.lit("tool"), F.lit(False))
    piece = F.concat(
        F.when(first, render_head(F.col("role"), F.col("content"))).otherwise(F.lit("")),
        render_message(F.col("role"), F.col("content"), F.lit(None).cast(TOOL_CALL_TYPE),
                       first, is_tool("_prev"), is_tool("_next")))
    return rows.groupBy(id_col).agg(F.sum(token_count(piece)).cast("bigint").alias("n_tokens"),
                                    F.count(F.lit(1)).cast("bigint").alias("n_messages"))


def sft_length_report(turns: DataFrame, max_length: int, id_col: str = "conv_id") -> DataFrame:
    """K3 for chat samples kept as a turns table: whole-conversation token
    counts (no conversation is collected), truncation, and samples whose cut
    keeps no supervised token (encoded from budget-pruned records)."""
    from ..operators.conversations import chat_records
    from ..operators.encode import encode_sft
    L = int(max_length)
    turns = turns.withColumn("_id", F.struct(id_col))  # equal for null ids, too
    counts = conversation_token_counts(turns, "_id")
    enc = encode_sft(chat_records(turns, "_id", max_tokens=L), id_col="_id", tools_col=None, max_length=L)
    sup = enc.select("_id", F.size(F.filter("labels", lambda t: t != F.lit(-100))).alias("n_sup"))
    return _sft_summary(counts.join(sup, "_id"), L)


def _sft_summary(t: DataFrame, L: int) -> DataFrame:
    return t.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_samples"),
        F.sum("n_tokens").cast("bigint").alias("total_tokens"),
        F.max("n_tokens").cast("bigint").alias("max_tokens"),
        F.sum((F.col("n_tokens") > L).cast("bigint")).alias("n_truncated"),
        F.sum((F.col("n_sup") == 0).cast("bigint")).alias("n_no_supervised"),
        (F.sum("n_sup") / F.sum(F.least(F.col("n_tokens"), F.lit(L)))).alias("supervised_share"))


def chat_length_report(chat: DataFrame, max_length: int, messages_col: str = "messages",
                       tools_col: str | None = None) -> DataFrame:
    """K3 for chat records that already hold their message array (JSONL):
    whole-conversation token counts, truncation, unsupervised samples."""
    from ..functions.chat import render_chat
    from ..operators.encode import encode_sft
    L = int(max_length)
    tools = F.col(tools_col) if tools_col else None
    sized = chat.withColumn("_n", token_count(render_chat(F.col(messages_col), tools)))
    enc = encode_sft(sized, id_col="_n", messages_col=messages_col, tools_col=tools_col, max_length=L)
    sup = F.size(F.filter("labels", lambda t: t != F.lit(-100)))
    t = enc.select(F.col("_n").alias("n_tokens"), sup.alias("n_sup"))
    return _sft_summary(t, L)
