"""Headline benchmark: prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default: all registered queries),
BENCH_EVENT_LOG (optional folder for Spark's event log),
BENCH_REPEATS (timed runs per query, their median is reported; default 3),
BENCH_FILES (files of the copies that the encoders' throughput is measured on,
as on a cluster, where a table isn't one row group; default 16, 0: not measured).
Each query result is fully materialised with a no-op write, so the
measured time covers the whole plan without moving rows to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tokenloom import queries as Q  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tokenloom.session import build_session, shared_path  # noqa: E402

HEADLINE = ["pretrain_encode", "sft_encode", "dpo_encode", "epoch_plan", "batch_fetch",
            "history_prompts", "dpo_loss", "train_log_sample", "length_report"]


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(Q.REGISTRY)
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):  # stage/task times without the UI
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = build_session(app="tokenloom-bench", extra=extra)
    # Untimed warm-up on the smallest tables (JIT, class loading, Python workers).
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for name in names:
            Q.REGISTRY[name](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    fastest: dict[str, float] = {}
    rows: dict[str, int] = {}
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    for name in names:
        runs = []
        for _ in range(max(1, repeats)):  # plan + run, end to end
            t0 = time.time()
            df = Q.REGISTRY[name](spark, base)
            df.write.format("noop").mode("overwrite").save()
            runs.append(time.time() - t0)
        times[name], fastest[name] = round(median(runs), 3), round(min(runs), 3)
    total = round(sum(times.values()), 3)  # sum of per-query medians
    # Rows/s and tokens/s of the encoders over copies of their tables in several files.
    throughput = {}
    files = int(os.environ.get("BENCH_FILES", "16"))
    sources = {"pretrain_encode": ("documents", "n_label_tokens"), "sft_encode": ("conversations", "n_tokens"),
               "dpo_encode": ("conversations", None)}
    sources = {k: v for k, v in sources.items() if k in times and files}
    if sources:
        copies = shared_path(spark, "bench-copies")
        for table in {t for t, _ in sources.values()}:
            spark.read.parquet(f"{base}/{table}.parquet").repartition(files).write.parquet(f"{copies}/{table}.parquet")
    for name, (_, tok_col) in sources.items():
        runs = []
        for _ in range(max(1, repeats)):
            t0 = time.time()
            Q.REGISTRY[name](spark, copies).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - t0)
        out = Q.REGISTRY[name](spark, copies)
        r = out.agg(F.count(F.lit(1)).alias("n"), F.sum(tok_col or F.lit(0)).alias("t")).first()
        best = min(runs)
        throughput[name] = {"seconds": round(best, 3), "rows_per_s": round(r.n / best, 1)}
        if tok_col:
            throughput[name]["tokens_per_s"] = round((r.t or 0) / best, 1)
    head = sum(times[n] for n in HEADLINE if n in times)
    sf = base.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "headline_seconds": round(head, 3), "queries": times, "fastest": fastest,
                      "throughput": throughput,
                      "sf": float(sf) if sf.replace('.', '', 1).isdigit() else sf,
                      "cpus": int(os.environ.get("BENCH_CPUS", "8"))}))
    spark.stop()


if __name__ == "__main__":
    main()
