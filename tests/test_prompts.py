"""I1, J1-J5 on hand-made turns."""

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import prompts as PR

TURNS = [(1, 0, "system", "S"), (1, 1, "user", "u1"), (1, 2, "assistant", "a1"),
         (1, 3, "user", "u2"), (1, 4, "assistant", "a2"), (1, 5, "user", "u3"),
         (2, 0, "user", "only")]


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame(TURNS, "conv_id long, turn long, role string, content string")


@pytest.mark.parametrize("history,expected", [
    (0, {(1, 1): ["u1"], (1, 3): ["u2"], (1, 5): ["u3"], (2, 0): ["only"]}),
    (1, {(1, 1): ["S", "u1"], (1, 3): ["a1", "u2"], (1, 5): ["a2", "u3"], (2, 0): ["only"]}),
    (2, {(1, 1): ["S", "u1"], (1, 3): ["u1", "a1", "u2"], (1, 5): ["u2", "a2", "u3"], (2, 0): ["only"]}),
    (10, {(1, 1): ["S", "u1"], (1, 3): ["S", "u1", "a1", "u2"],
          (1, 5): ["S", "u1", "a1", "u2", "a2", "u3"], (2, 0): ["only"]}),
])
def test_history_window(turns, history, expected):
    got = {(r.conv_id, r.turn): [m.content for m in r.messages]
           for r in PR.history_messages(turns, history).collect()}
    assert got == expected


def test_prompt_with_system_in_window(turns):
    r = (PR.history_messages(turns, 1).where("conv_id = 1 and turn = 1")
         .select(PR.generation_prompt(F.col("messages")).alias("p")).first())
    assert r.p == "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nu1<|im_end|>\n<|im_start|>assistant\n"


def test_pretrain_prompt_ids(spark):
    df = spark.createDataFrame([("hé",)], "t string")
    ids = df.select(PR.prompt_ids(PR.pretrain_prompt(F.col("t"))).alias("x")).first().x
    assert list(ids) == [1, ord("h") + 3] + [b + 3 for b in "é".encode()]


def test_echo_generation_and_decode(turns):
    h = PR.history_messages(turns, 2)
    prompts = h.select("conv_id", "turn", PR.prompt_ids(PR.generation_prompt(F.col("messages"))).alias("prompt_ids"))
    out = PR.generate(prompts, PR.echo_predictor_factory)
    rep = out.select("conv_id", "turn", PR.reply_text(F.col("prompt_ids"), F.col("output_ids")).alias("reply"))
    got = {(r.conv_id, r.turn): r.reply for r in rep.collect()}
    assert got == {(1, 1): "u1", (1, 3): "u2", (1, 5): "u3", (2, 0): "only"}
    appended = PR.append_replies(turns, rep.where("conv_id = 2"))
    assert appended.where("conv_id = 2").count() == 2


def test_decode_multibyte(spark):
    df = spark.createDataFrame([([b + 3 for b in "日本😀".encode()],)], "ids array<int>")
    assert df.select(PR.decode_bytes(F.col("ids")).alias("t")).first().t == "日本😀"


def test_predictor_built_once_per_worker(spark, tmp_path):
    log = str(tmp_path / "calls.txt")

    def factory():  # a closure: pickled by value into every task
        with open(log, "a") as f:
            f.write("x\n")
        return lambda batch: [list(x) + [2] for x in batch]

    df = spark.range(64).repartition(16).select(F.array(F.col("id").cast("int")).alias("prompt_ids"))
    assert PR.generate(df, factory).count() == 64
    calls = len(open(log).read().splitlines())
    assert 1 <= calls < 16  # one per Python worker, not one per task


def test_history_blocks_match_window(spark):
    import random

    from pyspark.sql import Window
    rnd = random.Random(21)
    rows = [(c, t, rnd.choice(["user", "assistant", "system", "tool"]), f"m{c}-{t}")
            for c in range(5) for t in range(rnd.randint(1, 40))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, content string")
    for h in (0, 1, 3, 7, 50):
        w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(-h, 0)
        exp = {(r.conv_id, r.turn): [m.content for m in sorted(r.w, key=lambda x: x.turn)]
               for r in df.select("conv_id", "turn", "role",
                                  F.collect_list(F.struct("turn", "content")).over(w).alias("w"))
               .where("role = 'user'").collect()}
        got = {(r.conv_id, r.turn): [m.content for m in r.messages]
               for r in PR.history_messages(df, h).collect()}
        assert got == exp, h


def test_history_goes_by_position(spark):
    t = spark.createDataFrame([(1, 0, "user", "a"), (1, 5, "assistant", "b"), (1, 10, "user", "c")],
                              "conv_id long, turn long, role string, content string")
    got = {r.turn: [m.content for m in r.messages] for r in PR.history_messages(t, 2).collect()}
    assert got == {0: ["a"], 10: ["a", "b", "c"]}


def test_replies_in_mid_conversation_keep_turns_unique(spark, turns):
    rep = spark.createDataFrame([(1, 1, "new"), (1, 5, "last")], "conv_id long, turn long, reply string")
    rows = PR.append_replies(turns, rep).where("conv_id = 1").orderBy("turn").collect()
    assert len({r.turn for r in rows}) == len(rows) == 8
    assert [r.content for r in rows] == ["S", "u1", "new", "a1", "u2", "a2", "u3", "last"]


def test_long_reply_is_whole_and_other_ids_fail(spark):
    n = PR.MODEL_MAX_LENGTH * 4 + 77
    df = spark.range(1).select(F.array(F.lit(1)).alias("p"), F.concat(F.array(F.lit(1)), F.array_repeat(
        F.lit(ord("x") + 3), n)).alias("o"))
    assert df.select(F.length(PR.reply_text(F.col("p"), F.col("o"))).alias("n")).first().n == n
    bad = spark.range(1).select(PR.decode_bytes(F.array(F.lit(300), F.lit(6399))).alias("t"))
    with pytest.raises(Exception, match="byte tokenizer"):
        bad.collect()


def test_rounds_of_replies_are_numbered_without_gaps(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"{c}-{t}") for c in (1, None) for t in range(0, 40, 1)]
    rows += [(2, 5, "user", "gap"), (2, 90, "user", "after the gap"), (3, 0, "system", "no user")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, content string")
    for k in (1, 2):
        users = turns.where("role = 'user'")
        turns = PR.insert_replies(turns, users.select("conv_id", "turn", F.concat(F.lit(f"r{k} "), "content").alias("reply")))
        by_conv = {}
        for r in turns.orderBy("conv_id", "turn").collect():
            by_conv.setdefault(r.conv_id, []).append((r.turn, r.role, r.content))
        assert all([t for t, _, _ in v] == list(range(len(v))) for v in by_conv.values())
        for v in by_conv.values():  # each reply stands behind its own turn
            assert all(v[i + 1][2] == f"r{k} {c}" for i, (_, role, c) in enumerate(v) if role == "user")
    assert len(by_conv[1]) == len(by_conv[None]) == 80 and len(by_conv[2]) == 6 and len(by_conv[3]) == 1
    h = {(r.conv_id, r.turn): [m.content for m in r.messages] for r in PR.history_messages(turns, 3).collect()}
    assert h[2, 3] == ["gap", "r2 gap", "r1 gap", "after the gap"]


def test_a_hot_conversation_is_numbered(spark):
    turns = spark.range(5000).select(F.lit(7).cast("long").alias("conv_id"), (F.col("id") * 3).alias("turn"),
                                     F.lit("user").alias("role"), F.col("id").cast("string").alias("content"))
    replies = turns.where(F.col("turn") % 2 == 0).select("conv_id", "turn", F.lit("ok").alias("reply"))
    out = PR.insert_replies(turns, replies)
    stats = out.agg(F.count("*"), F.countDistinct("turn"), F.min("turn"), F.max("turn")).first()
    assert tuple(stats) == (7500, 7500, 0, 7499)


def test_predictor_gets_bounded_batches(spark):
    from tokenloom.functions.util import SLICE_SIZE

    def factory():
        def predict(batch):
            assert sum(map(len, batch)) <= SLICE_SIZE
            return [[*x, 5] for x in batch]
        return predict

    df = spark.range(2000).coalesce(1).select("id", F.array_repeat(F.col("id").cast("int"), 500).alias("prompt_ids"))
    rows = PR.generate(df, factory).select("id", F.size("output_ids").alias("n"), F.element_at("output_ids", 500).alias("x")).collect()
    assert [(r.id, r.n, r.x) for r in rows] == [(i, 501, i) for i in range(2000)]
