"""End-to-end jobs: JSONL -> encoded Parquet -> plan -> delivered shards."""

import json
import os

from tokenloom import jobs
from tokenloom.plans import epochs as P


def _write(path, recs):
    with open(path, "w", encoding="utf-8") as f:
        for r in recs:
            f.write(json.dumps(r, ensure_ascii=False) + "\n")


def test_pretrain_job_end_to_end(spark, tmp_path):
    src = tmp_path / "pretrain.jsonl"
    _write(src, [{"text": f"sample {i} " * (i % 7)} for i in range(23)] + [{"text": "dup"}, {"text": "dup"}])
    enc = jobs.prepare_pretrain(spark, str(src), str(tmp_path / "enc"), max_length=32)
    assert enc.count() == 25 and enc.select("sample_id").distinct().count() == 25
    plan = jobs.plan_epochs(spark, str(tmp_path / "enc"), str(tmp_path / "plan"), epochs=2,
                            world_size=2, batch_size=4, progress={"epoch": 0, "step": 2, "world_size": 1})
    skip = P.rescaled_step(2, 1, 2)
    assert plan.where(f"epoch = 0 and step <= {skip}").count() == 0
    assert plan.where("epoch = 1").count() == 26  # 25 padded to a multiple of 2
    jobs.deliver(spark, str(tmp_path / "plan"), str(tmp_path / "enc"), str(tmp_path / "shards"))
    assert os.path.isdir(tmp_path / "shards" / "epoch=1" / "rank=0")
    assert spark.read.parquet(str(tmp_path / "shards")).count() == plan.count()


def test_sft_and_dpo_jobs(spark, tmp_path):
    sft = tmp_path / "sft.jsonl"
    _write(sft, [{"conversations": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a" * i}]}
                 for i in range(5)])
    out = jobs.prepare_sft(spark, str(sft), str(tmp_path / "sft_enc"), max_length=64).collect()
    assert len(out) == 5 and all(len(r.input_ids) == 64 for r in out)
    dpo = tmp_path / "dpo.jsonl"
    _write(dpo, [{"chosen": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "good"}],
                  "rejected": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "bad"}]}])
    r = jobs.prepare_dpo(spark, str(dpo), str(tmp_path / "dpo_enc"), max_length=64).first()
    assert len(r.x_chosen) == 63 and sum(r.mask_chosen) == 6 and sum(r.mask_rejected) == 5
