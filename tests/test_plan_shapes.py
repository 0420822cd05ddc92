"""
no cartesian or nested-loop joins, scans read only the needed columns."""

import re

import pytest

from conftest import SF001
from tokenloom import queries as Q

# These execute while being built.
SKIP = {"stream_encode", "stream_rejects", "training_shards", "jsonl_pretrain", "jsonl_sft", "jsonl_dpo", "train_log_roundtrip"}


def _plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(set(Q.REGISTRY) - SKIP))
def test_plan_shape(spark, name):
    plan = _plan(Q.REGISTRY[name](spark, SF001))
    for bad in ("BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"
    for schema in re.findall(r"ReadSchema: (struct<[^\n]*>)", plan):
        # the wide tables are never read whole
        assert "html" not in schema and "props" not in schema, f"{name}: {schema}"


@pytest.mark.parametrize("name,most", [
    ("pretrain_encode", 0), ("step_calendar", 0), ("update_batches", 1), ("dpo_pairs", 4), ("dpo_encode", 4),
    ("sft_length_report", 3), ("score_align", 2)])
def test_exchanges_without_broadcasts(spark, name, most):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = Q.REGISTRY[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, old)
    plan = plan.split("== Initial Plan ==")[-1]
    assert len(re.findall(r"Exchange (?:hash|range|round|Single)", plan)) <= most
