"""H1-H8 values, including the figures in FIXTURES.md."""

import math

from pyspark.sql import functions as F

from conftest import SF01
from tokenloom import queries as Q
from tokenloom.functions.scoring import log_softmax_at
from tokenloom.operators import scoring as SC


def test_dpo_fixture_figures(spark):
    r = Q.dpo_loss(spark, SF01).first()
    assert r.n_pairs == 25
    assert abs(r.loss - 0.693641) < 1e-6
    assert abs(r.mean_margin - (-0.000985)) < 1e-6
    assert r.n_positive == 9


def test_log_softmax_stable_with_large_logits(spark):
    df = spark.createDataFrame([([1000.0, 0.0, -1000.0], 0), ([1000.0, 0.0, -1000.0], 2),
                                ([0.0, 0.0], 1), ([1.0], 3)], "l array<double>, y int")
    got = [r.x for r in df.select(log_softmax_at(F.col("l"), F.col("y")).alias("x")).collect()]
    assert got[0] == 0.0
    assert abs(got[1] - (-2000.0)) < 1e-9
    assert abs(got[2] - math.log(0.5)) < 1e-12
    assert got[3] is None


def test_fully_masked_sequence_scores_zero(spark):
    rows = [(0, 0, -1.0, -2.0, 0), (0, 1, -3.0, -4.0, 0), (1, 0, -1.0, -1.0, 1), (1, 1, -3.0, -2.0, 1)]
    df = spark.createDataFrame(rows, "seq_id long, pos int, logp double, ref_logp double, mask int")
    out = {r.seq_id: r for r in SC.sequence_logprob(df, "seq_id", ["logp", "ref_logp"]).collect()}
    assert out[0].logp_avg == 0.0 and out[0].n_mask == 0
    assert out[1].logp_avg == -2.0 and out[1].ref_logp_avg == -1.5


def test_cross_entropy_empty_batch_is_null_and_token_weighted(spark):
    rows = [(0, [0.0, 0.0], 1), (0, [0.0, 0.0], -100), (1, [0.0, 0.0], -100),
            (2, [0.0, math.log(3.0)], 1), (2, [0.0, 0.0], 0), (2, [0.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "b long, logits array<double>, target int")
    out = {r.b: r for r in SC.masked_cross_entropy(df, ["b"]).collect()}
    assert out[1].loss is None and out[1].n_tokens == 0
    assert abs(out[0].loss - math.log(2)) < 1e-12
    exp = (-math.log(3 / 4) + 2 * math.log(2)) / 3  # mean over tokens, not rows
    assert abs(out[2].loss - exp) < 1e-12


def test_dpo_loss_at_zero_logit_is_ln2(spark):
    rows = [(0, "chosen", -1.0, -1.0, 1), (0, "rejected", -2.0, -2.0, 1)]
    df = spark.createDataFrame(rows, "pair_id long, side string, logp double, ref_logp double, mask int")
    s = SC.dpo_summary(SC.reward_margins(SC.pair_logratios(df))).first()
    assert abs(s.loss - math.log(2)) < 1e-12 and s.mean_margin == 0.0


def test_unnormalised_sequence_logprob(spark):
    rows = [(0, "chosen", -1.0, -1.0, 1), (0, "chosen", -3.0, -1.0, 1), (0, "rejected", -2.0, -2.0, 1)]
    df = spark.createDataFrame(rows, "pair_id long, side string, logp double, ref_logp double, mask int")
    p = SC.pair_logratios(df, normalize=False).first()
    assert p.policy_chosen == -4.0 and p.ref_chosen == -2.0 and p.logit == (-4.0 + 2.0) - (-2.0 + 2.0)
    seq = SC.sequence_logprob(df.withColumn("seq", F.lit(1)), "seq", ["logp"], normalize=False).first()
    assert seq.logp_avg == -6.0


def _tokens(spark):
    rows = [(s, p, [float(p), float(s or 0), 1.0], (p * 7 + (s or 0)) % 3, int(p % 4 > 0))
            for s in (0, 1, None, 5) for p in range(23) if (s, p) != (1, 9)]
    return spark.createDataFrame(rows, "seq_id long, pos int, logits array<double>, label int, mask int")


def test_stored_targets_equal_a_plain_shift(spark, tmp_path):
    t = _tokens(spark).repartition(3)
    rows = {(r.seq_id, r.pos): r for r in t.collect()}
    for block in (4, 1000):
        stored = SC.token_table(t, str(tmp_path / f"b{block}"), n_buckets=5, block=block)
        got = SC.stored_targets(stored).collect()
        assert len(got) == len(rows) and stored.columns[:5] == t.columns
        for r in got:
            nxt = rows.get((r.seq_id, r.pos + 1))
            assert r.target == (nxt.label if nxt and nxt.mask == 1 else -100)
            assert r.logits == rows[r.seq_id, r.pos].logits
    plain = {(r.seq_id, r.pos): r.target for r in SC.shift_targets(t).where("seq_id is not null").collect()}
    assert plain == {(r.seq_id, r.pos): r.target for r in got if r.seq_id is not None}


def test_no_exchange_moves_logits(spark, tmp_path):
    stored = SC.token_table(_tokens(spark), str(tmp_path / "t"), n_buckets=4)
    out = SC.masked_cross_entropy(SC.stored_targets(stored).withColumn("b", F.col("seq_id") % 2), ["b"])
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanges) == 1 and "hashpartitioning(b" in exchanges[0]  # of the aggregate's narrow rows
    assert spark.catalog.listTables() == [t for t in spark.catalog.listTables() if not t.name.startswith("token_table")]


def test_slices_of_the_vocabulary_merge_in_any_order(spark):
    import random
    rng, rows, want = random.Random(2), [], {}
    for k in range(40):
        logits = [rng.choice([rng.uniform(-5, 5), 800.0, -900.0, float("-inf")]) for _ in range(rng.randint(3, 20))]
        logits[0] = 1.0
        label = rng.randrange(len(logits))
        cuts = sorted({0, *rng.sample(range(len(logits)), 2)})
        for a, b in zip(cuts, [*cuts[1:], len(logits)]):
            rows.append((k, label, a, logits[a:b]))
        top = max(logits)
        want[k] = logits[label] - top - math.log(sum(math.exp(x - top) for x in logits))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, label int, first int, logits array<double>")
    states = SC.slice_states(df, ["k"])
    parts = [SC.slice_states(df.where(F.col("first") == 0), ["k"]), SC.slice_states(df.where(F.col("first") > 0), ["k"])]
    later = SC.merge_states(parts[1].unionByName(parts[0]), ["k"])  # stored states, merged afterwards
    for found in (states, later):
        got = {r.k: r.logp for r in SC.with_state_logprob(found).collect()}
        assert all(got[k] == w or abs(got[k] - w) < 1e-9 for k, w in want.items()) and len(got) == 40


def test_slices_without_the_label_give_null(spark):
    df = spark.createDataFrame([(1, 9, 0, [1.0, 2.0]), (2, 1, 0, [1.0, 2.0]), (3, None, 0, [0.0]), (4, 0, 0, [])],
                               "k int, label int, first int, logits array<double>")
    got = {r.k: r.logp for r in SC.with_state_logprob(SC.slice_states(df, ["k"])).collect()}
    assert got[1] is None and got[3] is None and got[4] is None and got[2] is not None


def test_slices_are_combined_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 0, 0, [1.0])], "k int, label int, first int, logits array<double>")
    plan = SC.slice_states(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_collect_list" in plan
    assert not [line for line in plan.splitlines() if "Exchange" in line and "logits" in line]
