import random

import numpy as np
import pytest
from cases import DOCS, ROWS, docs_frame, empty_docs
from tokenloom.llm import quality_knn as Q, toxicity_nnpu as X

LABELS = "doc_id long, quality int, toxic int"


def make(n=400, seed=3):
    r = random.Random(seed)
    plain = ["house", "river", "green", "walks", "often", "little", "tree", "mountain", "sings", "warm"]
    rows, labels = [], []
    for i in range(n):
        ws = [r.choice(plain) + r.choice(["", "", "s", "ed", "ing"]) for _ in range(r.randrange(20, 80))]
        good, toxic = i % 4 != 0, i % 5 == 2
        if toxic:
            ws[3] = ws[9] = "vilestem" + r.choice(["a", "ou", "en"])
        if not good:
            ws = [w + "%%%" for w in ws]
        rows.append((i, " ".join(ws), 1))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def data(spark):
    rows, labels = make()
    return docs_frame(spark, rows + ROWS[5:8]), spark.createDataFrame(labels + [(None, 1, 1), (5000, None, None)], LABELS)


def accuracy(scored, labels, fold, held_out, column):
    rows = scored.select("doc_id", "score").join(labels, "doc_id").where(
        Q.fold_column(Q.F.col("doc_id"), fold) == held_out).collect()
    assert len(rows) > 50
    return np.mean([(r.score >= 0.5) == r[column] for r in rows])


def test_quality_held_out(spark, data):
    docs, labels = data
    model = Q.fit_quality(docs, labels)
    scored = Q.score_quality(docs, model)
    assert scored.count() == docs.count() and dict(scored.dtypes)["score"] == "double"
    assert accuracy(scored, labels, 3, 1, "quality") > 0.97
    blocked = model.scores([t.encode() for _, t, _ in ROWS if t])
    one_by_one = np.concatenate([model.scores([t.encode()]) for _, t, _ in ROWS if t])
    assert np.allclose(blocked, one_by_one, atol=1e-6)
    empty = {r.doc_id: r.score for r in scored.where("text is null or text = ''").collect()}
    assert set(empty.values()) == {model.prior}


def test_votes_are_exact(data):
    """Against a plain computation of all cosines and a sort."""
    rows, labels = make(60)
    shares = Q.term_shares([t.encode() for _, t, _ in rows])
    model = Q.fit_knn(shares, np.array([q for _, q, _ in labels]))
    z = model.project(Q.term_shares([b"house%%% river%%% tree%%% sings%%%"]))[0]
    cosine = model.vectors @ z
    near = np.argsort(-cosine)[:Q.NEIGHBOURS]
    vote = np.maximum(cosine[near], 0) ** Q.SHARPNESS + 1e-9
    want = (vote * model.labels[near]).sum() / vote.sum()
    assert model.scores([b"house%%% river%%% tree%%% sings%%%"])[0] == pytest.approx(want, abs=1e-4)


def test_toxicity_held_out(spark, data):
    docs, labels = data
    model = X.fit_toxicity(docs, labels)
    scored = X.score_toxicity(docs, model)
    assert accuracy(scored, labels, 5, 0, "toxic") > 0.95
    again = X.score_toxicity(docs, X.fit_toxicity(docs, labels)).where("doc_id = 12").first()
    assert again.score == scored.where("doc_id = 12").first().score


def test_held_out_labels_are_not_read(spark, data):
    docs, labels = data
    fold = X.fold_column(X.F.col("doc_id"), 5)
    flipped = labels.withColumn("toxic", X.F.when(fold == 0, 1 - X.F.col("toxic")).otherwise(X.F.col("toxic")))
    assert np.array_equal(X.fit_toxicity(docs, labels).weights, X.fit_toxicity(docs, flipped).weights)
    fold = X.fold_column(X.F.col("doc_id"), 3)
    flipped = labels.withColumn("quality", X.F.when(fold == 1, 1 - X.F.col("quality")).otherwise(X.F.col("quality")))
    a, b = Q.fit_quality(docs, labels), Q.fit_quality(docs, flipped)
    assert np.array_equal(a.vectors, b.vectors) and np.array_equal(a.labels, b.labels)


def test_few_or_no_labels(spark, data):
    docs, labels = data
    none = labels.limit(0)
    assert {r.score for r in Q.score_quality(docs, Q.fit_quality(docs, none)).collect()} == {0.5}
    assert max(r.score for r in X.score_toxicity(docs, X.fit_toxicity(docs, none)).collect()) < 1e-3
    one = labels.where("quality = 1")
    assert {r.score for r in Q.score_quality(docs, Q.fit_quality(docs, one)).collect()} == {1.0}
    model = Q.fit_quality(docs, labels)
    assert Q.score_quality(empty_docs(spark), model).count() == 0
    assert Q.score_quality(docs_frame(spark), model).count() == len(ROWS)
    assert X.score_toxicity(docs_frame(spark), X.fit_toxicity(docs, labels)).columns == [
        f.name for f in DOCS if f.name != "score"] + ["score"]
    empty = empty_docs(spark)
    assert Q.fit_quality(empty, labels).prior == 0.5
    assert X.fit_toxicity(empty, labels).weights.any() == False  # noqa: E712
