"""Each stage on its own input, and what the entry does without the package."""

import subprocess
import sys
import textwrap
from pathlib import Path

import corpus_pipeline as C
import pytest
from cases import DOCS, ROWS, docs_frame
from conftest import SF001
from tokenloom.llm import bottomk_dedup, decontaminate, quality_knn, toxicity_nnpu


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages(spark, docs):
    table = quality_knn.score_quality(docs, quality_knn.fit_quality(docs, spark.read.parquet(f"{SF001}/labels.parquet")))
    good = C.quality(spark, docs, SF001)
    assert ids(good) == ids(table.where("score >= 0.5")) and good.columns == docs.columns
    table = toxicity_nnpu.score_toxicity(docs, toxicity_nnpu.fit_toxicity(docs, spark.read.parquet(f"{SF001}/labels.parquet")))
    assert ids(C.toxicity(spark, docs, SF001)) == ids(table.where("score < 0.5"))
    assert ids(C.near_dedup(spark, docs, SF001)) == ids(bottomk_dedup.near_duplicates(docs).where("kept"))
    table = decontaminate.contamination_report(docs, spark.read.parquet(f"{SF001}/benchmark.parquet"))
    assert ids(C.decontamination(spark, docs, SF001)) == ids(table.where("not contaminated"))
    assert ids(C.bpe(spark, docs, SF001)) == ids(docs)


def test_run_applies_all(spark, docs):
    got = C.run(spark, SF001)
    left = docs
    for _, stage in C.STAGES:
        left = stage(spark, left, SF001)
    assert ids(got) == ids(left) and 0 < got.count() < docs.count()


def test_odd_rows_pass(spark):
    odd = docs_frame(spark)
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, odd, SF001)
        assert out.columns == [f.name for f in DOCS], name
        assert stage(spark, odd.limit(0), SF001).count() == 0
    assert C.decontamination(spark, odd, SF001).count() == len(ROWS)


def test_entry_without_the_package(tmp_path):
    repo = Path(C.__file__).parent
    code = textwrap.dedent("""
        import sys
        class Absent:
            def find_spec(self, name, path=None, target=None):
                if name in ("corpus_pipeline", "tokenloom.llm"):
                    raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        sys.meta_path.insert(0, Absent())
        import __spark_entry__ as e
        names = set(e.queries())
        assert "sft_encode" in names and not any(n.startswith("op") or n == "pipeline" for n in names)
        e.oracle_sql()
    """)
    subprocess.run([sys.executable, "-c", code], cwd=repo, check=True)
