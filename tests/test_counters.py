"""K3 state: counters merge, and a report from them equals the direct one."""

from pyspark.sql import functions as F

from conftest import SF01
from tokenloom.operators import counters as CN
from tokenloom.operators.report import length_report


def _sorted(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_halves_merge_to_the_whole(spark, tmp_path):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    whole = CN.length_counters(docs, ["lang"])
    path = str(tmp_path / "state")
    for k in (0, 1):
        CN.store_counters(CN.length_counters(docs.where(F.col("doc_id") % 2 == k), ["lang"]), path, str(k))
    cols = ["lang", "n_tokens", "n"]
    assert _sorted(CN.stored_counters(spark, path, ["lang"]), cols) == _sorted(whole, cols)
    CN.store_counters(CN.length_counters(docs.where("doc_id % 2 = 1"), ["lang"]), path, "1")  # again: replaced
    merged = CN.stored_counters(spark, path, ["lang"])
    assert _sorted(merged, cols) == _sorted(whole, cols)
    same = ["lang", "n_docs", "total_tokens", "avg_tokens", "max_tokens", "n_truncated", "pad_share"]
    got = CN.report_from_counters(merged, ["lang"], 512)
    want = length_report(docs, ["lang"], 512)
    assert _sorted(got, [*same, "q50_tokens"]) == _sorted(want, [*same, "median_tokens"])


def test_quantiles_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(None, "a" * k) for k in range(1, 11)] + [("x", None)], "g string, text string")
    out = {r.g: r for r in CN.report_from_counters(
        CN.length_counters(df, ["g"]), ["g"], 512, quantiles=(0.0, 0.1, 0.5, 0.95, 1.0)).collect()}
    r = out[None]
    assert (r.q0_tokens, r.q10_tokens, r.q50_tokens, r.q95_tokens, r.q100_tokens) == (1, 1, 5, 10, 10)
    assert out["x"].total_tokens == len("None")
    assert CN.report_from_counters(CN.length_counters(df.limit(0), ["g"]), ["g"], 512).count() == 0
