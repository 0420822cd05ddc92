"""Batches of bounded padded size, and generation that resumes."""

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import batches as BT


def _prompts(spark, lengths):
    return spark.createDataFrame([(k, list(range(n))) for k, n in enumerate(lengths)], "k int, prompt_ids array<int>")


def test_width_classes(spark):
    got = [(r.id, r.w) for r in spark.range(5000).select("id", BT.width_class(F.col("id")).alias("w")).collect()]
    assert all(n <= w <= max(1, n * 9 / 8) for n, w in got)
    assert [w for n, w in got if 1 <= n <= 16] == list(range(1, 17))
    assert len({w for _, w in got}) < 100


def test_every_batch_keeps_the_budget(spark):
    import random
    rng = random.Random(1)
    lengths = [rng.choice([0, 1, 3, 17, 17, 17, 40, 300, 900]) for _ in range(700)]
    packed = BT.pack(_prompts(spark, lengths), ["k"], 500).collect()
    batches = {}
    for r in packed:
        batches.setdefault((r.batch_width, r.batch_no), []).append(len(r.prompt_ids))
    assert sorted(r.k for r in packed) == list(range(700))
    for sizes in batches.values():
        assert len(sizes) * max(sizes) <= 500 or len(sizes) == 1
    # full but for the last batch of a width
    for (width, no), sizes in batches.items():
        if (width, no + 1) in batches:
            assert len(sizes) == max(1, 500 // width)


def test_predictor_sees_whole_batches(spark):
    def factory():
        return lambda batch: [[len(batch), len(x)] for x in batch]

    packed = BT.pack(_prompts(spark, [10] * 25), ["k"], 100)
    out = BT.generate_packed(packed, factory).collect()
    assert sorted(r.output_ids[0] for r in out) == [5] * 5 + [10] * 20


def test_a_killed_run_resumes(spark, tmp_path):
    path, log = str(tmp_path / "out"), str(tmp_path / "calls")
    prompts = _prompts(spark, [5] * 60 + [9] * 40).withColumn("k", F.when(F.col("k") > 0, F.col("k")))  # a null key, too

    def failing(limit):
        def factory():
            def predict(batch):
                with open(log, "a") as f:
                    f.write(f"{len(batch)}\n")
                if sum(map(int, open(log).read().split())) > limit:
                    raise RuntimeError("killed")
                return [[*x, 7] for x in batch]
            return predict
        return factory

    with pytest.raises(Exception, match="killed"):
        BT.generate_to(prompts, ["k"], path, failing(40), 200, rounds=5)
    first = spark.read.parquet(path).count()
    assert 0 < first < 100
    open(log, "w").close()
    out = BT.generate_to(prompts, ["k"], path, failing(10 ** 6), 200, rounds=5)
    assert out.count() == 100 and out.select("k").distinct().count() == 100
    assert sum(map(int, open(log).read().split())) == 100 - first  # only what was missing
    before = out.count()
    assert BT.generate_to(prompts, ["k"], path, failing(10 ** 6), 200, rounds=3).count() == before


def test_no_prompts(spark, tmp_path):
    assert BT.batch_report(BT.pack(_prompts(spark, []), ["k"], 100)).collect() == []
