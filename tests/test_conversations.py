"""K1/K2 with the token budget: pruned turns never change the samples."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tokenloom.operators import conversations as conv
from tokenloom.operators.encode import encode_dpo, encode_sft
from tokenloom.plans.ranking import grouped_running_total

ROLES = ["user", "assistant", "tool", "tool", "system", "critic"]


def _turns(spark, n_convs=6, max_turns=150, seed=3):
    rnd = random.Random(seed)
    rows = []
    for c in range(n_convs):
        for t in range(rnd.randint(1, max_turns)):
            role = "user" if t == 0 else rnd.choice(ROLES)
            rows.append((c, t, role, "x" * rnd.randint(0, 3)))
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, content string")


def _rows(df, key):
    return sorted((r[key], list(r.input_ids), list(r.labels)) for r in df.collect())


def test_budget_pruning_keeps_sft_samples(spark):
    turns = _turns(spark)
    for L in (24, 64, 200):
        full = encode_sft(conv.chat_records(turns), id_col="conv_id", tools_col=None, max_length=L)
        cut = encode_sft(conv.chat_records(turns, max_tokens=L), id_col="conv_id", tools_col=None, max_length=L)
        assert _rows(full, "conv_id") == _rows(cut, "conv_id")
    pruned = conv.within_budget(turns, 24).count()
    assert pruned < turns.count()


def test_budget_pruning_keeps_dpo_samples(spark):
    turns = _turns(spark, seed=5)
    L = 40
    a = encode_dpo(conv.preference_pairs(turns), max_length=L)
    b = encode_dpo(conv.preference_pairs(turns, max_tokens=L), max_length=L)
    key = lambda r: (r.pair_id, list(r.x_chosen), list(r.mask_chosen), list(r.x_rejected), list(r.mask_rejected))
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def test_pairs_keep_the_null_conversation(spark):
    turns = spark.createDataFrame([(i, k, role, f"{role} {i}") for i in (None, 3, 8)
                                   for k, role in enumerate(("user", "assistant"))],
                                  "conv_id long, turn int, role string, content string")
    for most in (None, 400):
        got = {r.pair_id: (r.chosen[1].content, r.rejected[1].content)
               for r in conv.preference_pairs(turns, max_tokens=most).collect()}
        said = {i: f"assistant {i}" for i in (None, 3, 8)}
        assert got == {None: (said[None], said[3]), 3: (said[3], said[8]), 8: (said[8], said[None])}


def test_running_total_matches_window(spark):
    turns = _turns(spark, n_convs=3, max_turns=400, seed=9)
    known = F.col("role").isin(*conv.KNOWN_ROLES).cast("bigint")
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    exp = {(r.conv_id, r.turn, r.k) for r in turns.select(
        "conv_id", "turn", F.coalesce(F.sum(known).over(w), F.lit(0)).alias("k")).collect()}
    for sub in (None, 7):
        got = {(r.conv_id, r.turn, r.k) for r in grouped_running_total(
            turns, ["conv_id"], "turn", known, "k", inclusive=False, sub_buckets=sub).collect()}
        assert got == exp


def test_conversation_token_counts_equal_whole_render(spark):
    from tokenloom.functions.chat import render_chat
    from tokenloom.functions.tokens import token_count
    from tokenloom.operators.report import chat_length_report, conversation_token_counts, sft_length_report
    turns = _turns(spark, n_convs=8, max_turns=40, seed=13)
    exp = {r.conv_id: r.n for r in conv.chat_records(turns).select(
        "conv_id", token_count(render_chat(F.col("messages"))).alias("n")).collect()}
    got = {r.conv_id: r.n_tokens for r in conversation_token_counts(turns).collect()}
    assert got == exp
    a = sft_length_report(turns, 64).first()
    b = chat_length_report(conv.chat_records(turns), 64).first()
    assert a == b


def test_length_report_counts_the_conversation_without_id(spark):
    from tokenloom.operators.report import sft_length_report
    rows = [(None, 0, "user", "hi"), (None, 1, "assistant", "yes"), (3, 0, "user", "a"), (3, 1, "assistant", "b")]
    out = sft_length_report(spark.createDataFrame(rows, "conv_id long, turn long, role string, content string"), 512).first()
    assert out.n_samples == 2 and out.n_no_supervised == 0
