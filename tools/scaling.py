"""Encode throughput at 1, 2 and 4 cores (separate processes).

Usage: python tools/scaling.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = {}
    for cpus in (1, 2, 4):
        env = dict(os.environ, BENCH_CPUS=str(cpus), BENCH_SF_DIR=base,
                   BENCH_QUERIES="pretrain_encode,sft_encode,dpo_encode")
        res = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                             capture_output=True, text=True, timeout=3600)
        line = [x for x in res.stdout.splitlines() if x.startswith("{")][-1]
        out[cpus] = json.loads(line)["queries"]
    speedup = {q: {c: round(out[1][q] / out[c][q], 2) for c in out} for q in out[1]}
    print(json.dumps({"seconds": out, "speedup_vs_1_core": speedup}))


if __name__ == "__main__":
    main()
