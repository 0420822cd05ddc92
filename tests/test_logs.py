"""A5-A8, E2, I2 on small hand-made logs."""

import datetime as dt
import math
import os

from pyspark.sql import functions as F

from tokenloom.operators import logs as LG
from tokenloom.plans import epochs as P


def test_progress_append_then_latest(spark, tmp_path):
    path = str(tmp_path / "progress")
    first = spark.createDataFrame([("a", 0, 10, 2, None), ("b", 0, 5, 1, "w1")],
                                  "run string, epoch int, step long, world_size int, wandb_id string")
    second = spark.createDataFrame([("a", 1, 3, 4, "w2"), ("b", 0, 4, 1, None)], first.schema)
    LG.append_log(first, path)
    LG.append_log(second, path)
    got = {r.run: (r.epoch, r.step, r.world_size) for r in LG.latest_progress(spark.read.parquet(path)).collect()}
    assert got == {"a": (1, 3, 4), "b": (0, 5, 1)}
    assert P.rescaled_step(3, 4, 2) == 6


def test_logged_steps_and_eta(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0 + dt.timedelta(seconds=30 * i), i, float(i)) for i in range(25)]
    log = spark.createDataFrame(rows, "run long, ts timestamp_ntz, event_id long, loss double")
    steps = LG.number_steps(log, tiebreak=["event_id"])
    logged = LG.logged_steps(steps, 10, 1e-3).select(
        "step", "iters", "lr", LG.eta_minutes().alias("eta"), LG.spent_seconds().alias("spent")).collect()
    assert [r.step for r in sorted(logged, key=lambda r: r.step)] == [10, 20, 24]  # 24 == iters - 1
    for r in logged:
        spent = 30.0 * (r.step - 1)
        assert r.spent == spent
        assert r.eta == math.floor(spent / (r.step + 1) * r.iters / 60) - math.floor(spent / 60)
        assert abs(r.lr - (1e-4 + 0.5e-3 * (1 + math.cos(math.pi * r.step / r.iters)))) < 1e-15


def test_training_shards_in_step_order(spark, tmp_path):
    ids = spark.range(50).withColumnRenamed("id", "sample_id")
    m = P.build_manifest(ids, 1, 2, 4, n=50)
    enc = ids.select("sample_id", F.array(F.col("sample_id").cast("int")).alias("input_ids"))
    path = str(tmp_path / "shards")
    P.write_training_shards(m, enc, path, n_parts=6)
    for rank in (0, 1):
        folder = os.path.join(path, "epoch=0", f"rank={rank}")
        steps = []
        for f in sorted(x for x in os.listdir(folder) if x.endswith(".parquet")):
            steps += [(r.step, r.slot) for r in spark.read.parquet(os.path.join(folder, f)).collect()]
        assert steps == sorted(steps) and len(steps) == 25


def test_eta_since_restart(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0, t0 + dt.timedelta(seconds=600), 15, 100)]
    df = spark.createDataFrame(rows, "run long, run_start timestamp_ntz, ts timestamp_ntz, step long, iters long")
    r = df.select(LG.eta_minutes().alias("a"), LG.eta_minutes_since_restart(F.lit(10)).alias("b")).first()
    assert r.a == math.floor(600 / 16 * 100 / 60) - 10
    assert r.b == math.floor(600 / 5 * 85 / 60)


def test_a_null_run_is_a_run(spark):
    rows = [(None, dt.datetime(2024, 1, 1, 0, i), i, 1.0 + i) for i in range(3)] + [(4, dt.datetime(2024, 1, 1), 9, 5.0)]
    log = spark.createDataFrame(rows, "run long, ts timestamp_ntz, event_id long, loss double")
    steps = LG.number_steps(log, tiebreak=["event_id"])
    assert sorted((str(r.run), r.step, r.iters) for r in steps.collect()) == [
        ("4", 1, 1), ("None", 1, 3), ("None", 2, 3), ("None", 3, 3)]
    latest = {r.run: r.step for r in LG.latest_progress(steps.select("run", F.lit(0).alias("epoch"), "step")).collect()}
    assert latest == {None: 3, 4: 1}
