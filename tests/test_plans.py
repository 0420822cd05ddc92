"""Manifest invariants and the skip-batch semantics."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01
from tokenloom.plans import epochs as P
from tokenloom.plans.ranges import RANGE, group_positions, positions, sorted_ranges, with_successor
from tokenloom.plans.ranking import grouped_rank


def py_skip_batches(indices, bs, skip):
    """Chunks of ``bs`` by slicing, without the first ``skip``."""
    return [indices[i:i + bs] for i in range(0, len(indices), bs)][skip:]


def test_step_filter_equals_skip_sampler_arithmetic():
    for n in range(40):
        for bs in range(1, 9):
            for skip in range(12):
                idx = list(range(n))
                exp = py_skip_batches(idx, bs, skip)
                got = {}
                for pos in idx:
                    step = pos // bs + 1
                    if step > skip:
                        got.setdefault(step, []).append(pos)
                assert [got[k] for k in sorted(got)] == exp
                assert len(exp) == P.batches_per_rank(n, 1, bs, skip)


def test_manifest_resume_matches_sampler(spark):
    for n in (0, 1, 9, 33):
        ids = spark.range(n).withColumnRenamed("id", "sample_id")
        for bs in (1, 3, 8):
            m = P.build_manifest(ids, 1, 1, bs, n=n).cache()
            order = [r.sample_id for r in m.orderBy("pos").collect()]
            for skip in (0, 2, 12):
                rows = P.resume(m, 0, skip).collect()
                got = {}
                for r in sorted(rows, key=lambda r: (r.step, r.slot)):
                    got.setdefault(r.step, []).append(r.sample_id)
                assert [got[k] for k in sorted(got)] == py_skip_batches(order, bs, skip)
            m.unpersist()


def test_each_epoch_is_a_permutation(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select(F.col("doc_id").alias("sample_id"))
    m = P.build_manifest(docs, 3, 1, 16)
    stats = m.groupBy("epoch").agg(F.count("*").alias("n"), F.countDistinct("sample_id").alias("d"),
                                   F.min("pos").alias("lo"), F.max("pos").alias("hi"),
                                   F.countDistinct("pos").alias("dp")).collect()
    assert len(stats) == 3
    for s in stats:
        assert s.n == s.d == s.dp == 1000 and s.lo == 0 and s.hi == 999
    firsts = {r.epoch: r.sample_id for r in m.where("pos = 0").collect()}
    assert len(set(firsts.values())) > 1  # epochs are shuffled differently


def test_ranks_disjoint_except_wrap_padding(spark):
    ids = spark.range(10).withColumnRenamed("id", "sample_id")
    m = P.build_manifest(ids, 1, 4, 2, n=10).collect()
    assert len(m) == 12  # padded to a multiple of 4
    by_rank = {}
    for r in m:
        by_rank.setdefault(r.rank, []).append(r.sample_id)
    assert sorted(len(v) for v in by_rank.values()) == [3, 3, 3, 3]
    flat = [s for v in by_rank.values() for s in v]
    assert len(set(flat)) == 10
    order = {r.pos: r.sample_id for r in m}
    assert order[10] == order[0] and order[11] == order[1]


def test_world_larger_than_n_wraps_repeatedly(spark):
    ids = spark.range(2).withColumnRenamed("id", "sample_id")
    m = {r.pos: r.sample_id for r in P.build_manifest(ids, 1, 5, 1, n=2).collect()}
    assert sorted(m) == [0, 1, 2, 3, 4]
    assert m[2] == m[0] and m[4] == m[0] and m[3] == m[1]


def test_plan_independent_of_partitioning(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select(F.col("doc_id").alias("sample_id"))
    a = P.build_manifest(docs.repartition(7), 2, 3, 8).collect()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = P.build_manifest(docs.repartition(2), 2, 3, 8).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted(a) == sorted(b)


def test_rescaled_step():
    assert P.rescaled_step(7, 2, 3) == 4
    assert P.rescaled_step(7, 3, 3) == 7
    assert P.rescaled_step(5, 1, 2) == 2


def test_global_and_grouped_rank_equal_window(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    hot = ev.withColumn("g", F.when(F.col("user_id") < 100, F.lit(0)).otherwise(F.col("user_id")))
    w = Window.partitionBy("g").orderBy("value", "event_id")
    exp = {(r.event_id, r.p) for r in hot.select("event_id", (F.row_number().over(w) - 1).alias("p")).collect()}
    got = {(r.event_id, r.pos) for r in grouped_rank(hot, ["g"], "value", ["event_id"], sub_buckets=8)
           .select("event_id", "pos").collect()}
    assert got == exp
    w2 = Window.orderBy("value", "event_id")
    exp2 = {(r.event_id, r.p) for r in ev.select("event_id", (F.row_number().over(w2) - 1).alias("p")).collect()}
    got2 = {(r.event_id, r.pos) for r in positions(ev, ["value", "event_id"]).select("event_id", "pos").collect()}
    assert got2 == exp2
    got3 = {(r.event_id, r.pos) for r in group_positions(hot, ["g"], ["value", "event_id"])
            .select("event_id", "pos").collect()}
    assert got3 == exp


def test_update_number_closed_form():
    from pyspark.sql import SparkSession  # noqa: F401
    for a in (1, 2, 4):
        for iters in (1, 5, 8):
            count = 0
            seen = {}
            for epoch in range(3):
                for step in range(1, iters + 1):
                    if (step + 1) % a == 0:
                        count += 1
                    seen[(epoch, step)] = count
            per_epoch = (iters + 1) // a - 1 // a
            for (epoch, step), v in seen.items():
                assert epoch * per_epoch + (step + 1) // a - 1 // a == v
    assert math.isclose(5e-4 / 10 + 0.5 * 5e-4 * (1 + math.cos(math.pi)), 5e-5)


def test_grouped_rank_adaptive_hot_group(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    hot = ev.withColumn("g", F.when(F.col("user_id") < 100, F.lit(0)).otherwise(F.col("user_id")))
    w = Window.partitionBy("g").orderBy("ts", "event_id")
    exp = {(r.event_id, r.p) for r in hot.select("event_id", (F.row_number().over(w) - 1).alias("p")).collect()}
    keyed = hot.withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    got = {(r.event_id, r.pos) for r in grouped_rank(keyed, ["g"], "us", ["event_id"], rows_per_bucket=500)
           .select("event_id", "pos").collect()}
    assert got == exp


def test_resume_exact_has_no_repeats_or_gaps(spark):
    ids = spark.range(100).withColumnRenamed("id", "sample_id")
    perm = P.epoch_permutation(ids, 1)
    saved_world, bs, step = 2, 4, 5
    consumed = P.consumed_samples(step, bs, saved_world)
    old = P.build_manifest(ids, 1, saved_world, bs, n=100)
    done = {r.sample_id for r in old.where(f"step <= {step}").collect()}
    rest = P.resume_exact(perm, consumed, 3, bs).collect()
    left = [r.sample_id for r in rest]
    assert len(done) == consumed and len(left) == 100 - consumed
    assert done.isdisjoint(left) and done | set(left) == set(range(100))
    assert {r.rank for r in rest} == {0, 1, 2}


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_positions_in_many_ranges_plan_in_constant_size(spark):
    ids = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("k"))
    few = positions(ids, ["k"], unique=True)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        many = positions(ids, ["k"], unique=True)
        assert [r.pos for r in many.orderBy("k").collect()] == list(range(3000))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert _plan(many).count("\n") == _plan(few).count("\n")


def test_equal_and_null_keys_are_spread_over_ranges(spark):
    rows = [(None,)] * 1000 + [(5,)] * 1000 + [(i % 997,) for i in range(1000)]
    df = spark.createDataFrame(rows, "k int").repartition(3)
    sizes = [r["count"] for r in sorted_ranges(df, ["k"], n_ranges=20).groupBy(RANGE).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 600  # a third alone would be 1,000
    got = sorted((r.pos, r.k) for r in positions(df, ["k"]).collect())
    assert [p for p, _ in got] == list(range(3000))
    assert [k for _, k in got] == sorted((k for k, in rows), key=lambda k: (k is not None, k or 0))
    by_key = {}
    for r in group_positions(df, ["k"]).collect():
        by_key.setdefault(r.k, []).append(r.pos)
    assert all(sorted(v) == list(range(len(v))) for v in by_key.values()) and len(by_key[None]) == 1000


def test_group_positions_over_two_columns_and_no_rows(spark):
    df = spark.createDataFrame([(1, None, 3), (1, None, 1), (1, "a", 2), (None, "a", 9)], "x int, y string, o int")
    got = {(r.x, r.y, r.o): r.p for r in group_positions(df, ["x", "y"], ["o"], out_col="p").collect()}
    assert got == {(1, None, 3): 1, (1, None, 1): 0, (1, "a", 2): 0, (None, "a", 9): 0}
    assert positions(df.limit(0), ["x"]).count() == 0 and group_positions(df.limit(0), ["x"]).count() == 0


def test_successor_over_ranges(spark):
    for n in (0, 1, 2, 50):
        df = spark.range(n).select((F.col("id") * 3).alias("k"), (F.col("id") + 100).alias("v"))
        got = {r.k: r.next_v for r in with_successor(df, "k", ["v"]).collect()}
        assert got == {3 * i: (i + 1) % n + 100 for i in range(n)}


def test_natural_order_of_strings_and_repeated_ids(spark):
    ids = spark.createDataFrame([("b",), ("a",), ("a",), (None,), ("é",)], "sample_id string")
    got = P.epoch_permutation(ids, 2, shuffle=False).collect()
    for e in (0, 1):
        assert [r.sample_id for r in sorted((r for r in got if r.epoch == e), key=lambda r: r.pos)] == [
            None, "a", "a", "b", "é"]
        assert sorted(r.pos for r in got if r.epoch == e) == [0, 1, 2, 3, 4]


def test_step_sizes_are_those_of_the_manifest(spark):
    for n, world, batch in ((0, 2, 3), (1, 3, 8), (17, 2, 4), (24, 3, 8)):
        ids = spark.range(n).withColumnRenamed("id", "sample_id")
        m = P.build_manifest(ids, 2, world, batch, n=n).groupBy("epoch", "step").count().collect()
        s = P.step_sizes(spark, n, 2, world, batch).collect()
        assert sorted(map(tuple, m)) == sorted(map(tuple, s))


def test_first_update_has_three_micro_steps(spark):
    from tokenloom.plans import schedule as S
    steps = P.step_sizes(spark, 24 * 42, 2, 3, 8)
    got = steps.select("epoch", "step", S.update_group(F.col("epoch"), F.col("step"), F.lit(42), 4).alias("u")).collect()
    done, want = 0, []
    for e, s in sorted((r.epoch, r.step) for r in got):
        want.append((e, s, done + 1))
        done += (s + 1) % 4 == 0
    assert sorted((r.epoch, r.step, r.u) for r in got) == want
    assert sum(u == 1 for _, _, u in want) == 3 and sum(u == 2 for _, _, u in want) == 4


def _encoded(spark, ids, kind="long"):
    return spark.createDataFrame([(k, f"content {i}") for i, k in enumerate(ids)], f"sample_id {kind}, content string")


def test_one_sample_a_slot_for_any_ids(spark):
    for ids in ([1, 1, 2, None], [None, None, None], [5], [1, 2, 3, 4, 5], [7] * 20 + [None] * 20 + list(range(20))):
        enc = _encoded(spark, ids)
        for world in (1, 3):
            m = P.build_manifest(enc.select("sample_id"), 2, world, 2)
            rows = P.fetch_batches(m, enc).collect()
            padded = math.ceil(len(ids) / world) * world
            for epoch in (0, 1):
                got = [r for r in rows if r.epoch == epoch]
                assert len(got) == padded
                # each sample once but for the wrap padding, which repeats the first ones
                by_pos = {r.pos: r.content for r in got}
                assert sorted(by_pos[p] for p in range(len(ids))) == sorted(r.content for r in enc.collect())
                assert all(by_pos[p] == by_pos[p % len(ids)] for p in by_pos)


def test_copies_left_after_a_resume_are_those_not_delivered(spark):
    enc = _encoded(spark, [1, 1, 1, 1, None, None])
    m = P.build_manifest(enc.select("sample_id"), 1, 1, 2)
    first = {r.content for r in P.fetch_batches(m.where("step <= 1"), enc).collect()}
    rest = {r.content for r in P.fetch_batches(P.resume(m, 0, 1), enc).collect()}
    assert len(first) == 2 and len(rest) == 4 and first.isdisjoint(rest)


def test_plan_without_copies_is_refused_for_repeated_ids(spark):
    import pytest
    enc = _encoded(spark, [1, 1])
    m = P.build_manifest(enc.select("sample_id"), 1, 1, 2).drop("copy")
    with pytest.raises(ValueError, match="no column copy"):
        P.fetch_batches(m, enc)


def test_copies_of_an_id_are_shuffled(spark):
    enc = _encoded(spark, [None] * 300)
    m = P.build_manifest(enc.select("sample_id"), 2, 1, 4)
    order = {e: [r.copy for r in m.where(F.col("epoch") == e).orderBy("pos").collect()] for e in (0, 1)}
    assert sorted(order[0]) == sorted(order[1]) == list(range(300)) and order[0] != order[1] != list(range(300))


def test_delivery_follows_the_plan(spark, tmp_path):
    import glob
    enc = _encoded(spark, [*range(90), 3, None])
    m = P.build_manifest(enc.select("sample_id"), 2, 3, 4)
    parts, n = P.delivery_parts(m, 8)
    assert n >= 6 and parts.count() == 6
    P.write_training_shards(m, enc, str(tmp_path / "out"), n_parts=8)
    want = {}
    for r in P.fetch_batches(m, enc).collect():
        want.setdefault((r.epoch, r.rank), []).append((r.step, r.slot, r.content))
    for (epoch, rank), rows in want.items():
        files = sorted(glob.glob(str(tmp_path / f"out/epoch={epoch}/rank={rank}/*.parquet")))
        assert len(files) > 1
        got = [(r.step, r.slot, r.content) for f in files for r in spark.read.parquet(f).collect()]
        assert got == sorted(rows)


def test_delivery_samples_no_bounds_and_joins_once(spark):
    enc = _encoded(spark, range(50)).hint("merge")
    m = P.build_manifest(enc.select("sample_id"), 1, 2, 4)
    parts, n = P.delivery_parts(m, 4)
    rows = P.fetch_batches(m.join(parts, ["epoch", "rank"]), enc).repartitionById(n, "_base")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") <= 3


def test_feistel_is_a_permutation_with_an_inverse(spark):
    from tokenloom.plans import feistel as FE
    for n in (1, 2, 3, 10, 97, 1000, 4097):
        df = (spark.range(n).select("id", F.explode(F.array(F.lit(0), F.lit(7))).alias("e"))
              .withColumn("o", FE.ordinal_at(F.col("id"), F.col("e"), n))
              .withColumn("back", FE.position_of(F.col("o"), F.col("e"), n)))
        for r in df.groupBy("e").agg(F.countDistinct("o").alias("d"), F.min("o").alias("lo"), F.max("o").alias("hi"),
                                     F.sum((F.col("back") == F.col("id")).cast("int")).alias("same")).collect():
            assert (r.d, r.lo, r.hi, r.same) == (n, 0, n - 1, n)
    big = 10 ** 17 + 3  # beyond what a double holds
    rows = (spark.range(20).withColumn("p", F.lit(big - 20) + F.col("id"))
            .withColumn("o", FE.ordinal_at(F.col("p"), F.lit(3), big))
            .withColumn("back", FE.position_of(F.col("o"), F.lit(3), big)).collect())
    assert all(r.back == r.p and 0 <= r.o < big for r in rows) and len({r.o for r in rows}) == 20


def test_feistel_epochs_and_seeds_differ(spark):
    from tokenloom.plans import feistel as FE
    n = 500
    orders = {(e, s): [r.o for r in spark.range(n).select(FE.ordinal_at(F.col("id"), F.lit(e), n, s).alias("o")).collect()]
              for e in (0, 1) for s in (42, 99)}
    assert len({tuple(o) for o in orders.values()}) == 4
    for o in orders.values():  # no runs of neighbours are left
        assert sum(abs(x - y) == 1 for x, y in zip(o, o[1:])) < 10


def test_steps_of_all_ranks_are_the_padded_epoch(spark):
    from tokenloom.plans import feistel as FE
    for n, world, batch in ((10, 4, 2), (1, 3, 2), (24, 3, 8), (0, 2, 2)):
        got = {}
        for rank in range(world):
            for r in FE.rank_slots(spark, n, [0, 1], world, batch, rank, 1, 99).collect():
                assert r.rank == rank and r.pos == ((r.step - 1) * batch + r.slot) * world + rank
                got[r.epoch, r.pos] = r.ordinal
        total = math.ceil(n / world) * world if n else 0
        assert sorted(got) == [(e, p) for e in (0, 1) for p in range(total)]
        for e in (0, 1):
            assert sorted(got[e, p] for p in range(n)) == list(range(n))
            assert all(got[e, p] == got[e, p % n] for p in range(total))
        later = FE.rank_slots(spark, n, [1], world, batch, 0, 2, 2).collect()
        assert {(r.epoch, r.pos): r.ordinal for r in later} == {
            k: v for k, v in got.items() if k[0] == 1 and k[1] % world == 0 and k[1] // world // batch == 1}


def test_random_access_neither_sorts_nor_numbers(spark):
    from tokenloom.plans import feistel as FE
    samples = FE.with_ordinals(spark.createDataFrame([(k,) for k in ("b", "a", None, "b")], "sample_id string"))
    assert sorted((r.ordinal, r.sample_id or "") for r in samples.collect()) == [(0, ""), (1, "a"), (2, "b"), (3, "b")]
    slots = FE.rank_slots(spark, 4, [0], 2, 2, 0, 1, 1)
    rows = FE.fetch_steps(slots, samples, 2)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == 2 and "Sort" not in plan and "Window" not in plan and "Exchange hash" not in plan
    back = FE.with_positions(samples, [0], 4, 2, 2)
    assert sorted(r.pos for r in back.collect()) == [0, 1, 2, 3]
    assert "Exchange" not in back.where("epoch = 0")._jdf.queryExecution().optimizedPlan().toString()
