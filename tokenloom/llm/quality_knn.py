"""Quality classifier: similarity-weighted votes of the nearest labelled
documents in a latent-semantic space.

A text's terms are hashed n-grams of character classes (letters, capitals,
digits and white space are classes; other characters stand for themselves)
and signs of repeated words. Square roots of their shares, weighted by idf,
are projected by a truncated singular value decomposition of a bounded
labelled sample. The labelled vectors are sent to all tasks; every document
has its exact cosine products with all of them, block by block.

Cases: a null text counts as empty; the empty text has a vector of its own
(the zero vector) and the score of the labelled share, which is also every
score when all labels are equal; without labelled rows every score is 0.5.
Labels may be null (such rows aren't fitted). Ties in similarity are broken
by the order of the labelled rows. Repeated rows get equal scores; columns of
the input are kept unless they are named like an output column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batched, fold_column, text_or_empty

#: Bound on the labelled rows that are fitted.
MAX_LABELLED = 3072
DIMENSIONS, TERMS, NEIGHBOURS = 48, 2048, 25
SHARPNESS = 8.0  # power of the similarity in a vote
BLOCK = 512
_EXTRA = 4  # terms at the end: signs of repetition


def _classes() -> np.ndarray:
    """Byte to one of 41 character classes."""
    out = np.zeros(256, np.int32)  # letters and bytes of other characters
    out[ord("A"):ord("Z") + 1], out[ord("0"):ord("9") + 1] = 1, 2
    out[[9, 11, 12, 13, 32]], out[10] = 3, 4
    rest = [b for b in range(33, 127) if not chr(b).isalnum()]
    out[rest] = np.arange(5, 5 + len(rest))
    out[:9] = out[14:32] = out[127] = 5 + len(rest)
    return out


_CLASS = _classes()
_N = int(_CLASS.max()) + 1


def _gram_table(size: int, salt: int) -> np.ndarray:
    return np.random.default_rng(salt).integers(0, TERMS - _EXTRA, size, dtype=np.int32)


_PAIRS, _TRIPLES = _gram_table(_N ** 2, 2), _gram_table(_N ** 3, 3)


def term_shares(texts: list[bytes]) -> np.ndarray:
    """Square roots of the terms' shares, a row per text."""
    out = np.zeros((len(texts), TERMS), np.float32)
    for i, text in enumerate(texts):
        c = _CLASS[np.frombuffer(text, np.uint8)]
        if len(c) > 2:
            pair = c[:-1] * _N + c[1:]
            counts = np.bincount(_PAIRS[pair], minlength=TERMS) + np.bincount(
                _TRIPLES[pair[:-1] * _N + c[2:]], minlength=TERMS)
            out[i] = np.sqrt(counts / counts.sum())
        words = text.split()
        n = len(words)
        if n > 1:
            out[i, -4] = sum(map(eq, words, words[1:])) / n
            out[i, -3] = sum(map(eq, words, words[2:])) / n
            out[i, -2] = 1 - len(set(words)) / n
            out[i, -1] = 1 - len(set(zip(words, words[1:]))) / n
    return out


@dataclass
class KnnModel:
    idf: np.ndarray  # TERMS
    axes: np.ndarray  # TERMS x DIMENSIONS
    vectors: np.ndarray  # labelled rows x DIMENSIONS, of length one
    labels: np.ndarray
    prior: float

    def project(self, shares: np.ndarray) -> np.ndarray:
        z = (shares * self.idf) @ self.axes
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Share of label 1 in the votes of the nearest neighbours."""
        if not len(self.labels) or self.labels.min() == self.labels.max():
            return np.full(len(texts), self.prior)
        out = np.empty(len(texts))
        k = min(NEIGHBOURS, len(self.labels))
        for i in range(0, len(texts), BLOCK):
            z = self.project(term_shares(texts[i:i + BLOCK]))
            cosine = z @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            vote = np.maximum(np.take_along_axis(cosine, near, 1), 0.0).astype(float) ** SHARPNESS + 1e-9
            out[i:i + BLOCK] = (vote * self.labels[near]).sum(1) / vote.sum(1)
            out[i:i + BLOCK][~z.any(1)] = self.prior
        return np.clip(out, 0.0, 1.0)


def fit_knn(shares: np.ndarray, labels: np.ndarray) -> KnnModel:
    """Idf, axes of the truncated decomposition (by a randomised range
    finder) and the labelled vectors."""
    n = len(labels)
    prior = float(labels.mean()) if n else 0.5
    seen = (shares > 0).sum(0)
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)
    idf[-_EXTRA:] *= 2.0
    x = shares * idf
    d = min(DIMENSIONS, max(1, n))
    q = np.random.default_rng(7).standard_normal((TERMS, d + 8)).astype(np.float32)
    for _ in range(3):
        q = np.linalg.qr(x.T @ (x @ q))[0] if n else q
    axes = np.linalg.svd(x @ q, full_matrices=False)[2][:d] @ q.T if n else np.zeros((d, TERMS))
    model = KnnModel(idf, axes.T.astype(np.float32), np.zeros((0, d), np.float32), np.asarray(labels, float), prior)
    model.vectors = model.project(shares)
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, where: Column, limit: int) -> DataFrame:
    """(doc_id, label, text) of ``limit`` labelled rows at most: those with
    the smallest hashes of doc_id. ``where`` is over the column doc_id."""
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
            .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & where)
            .distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(limit))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
            .join(F.broadcast(rows), "doc_id"))  # ``limit`` rows


def fit_quality(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, label: str = "quality",
                fold: int = 3, held_out: int = 1) -> KnnModel:
    """Fit on labels of the rows whose crc32 fold isn't ``held_out``. Terms
    are counted in the tasks; ``limit`` rows of them reach the driver."""
    sample = labelled_sample(docs, labels, label, fold_column(F.col("doc_id"), fold) != held_out, limit)

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, y, t in zip(*[c.to_pylist() for c in b.columns]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i]), pa.array([y], pa.int32()), pa.array([term_shares([t.encode()]).tobytes()])],
                    names=["doc_id", "label", "terms"])

    got = (sample.select("doc_id", "label", "text").mapInArrow(terms, "doc_id long, label int, terms binary")
           .collect())
    got.sort(key=lambda r: (r["doc_id"], r["label"], bytes(r["terms"])))
    got = got[:limit]  # a doc_id may have several rows
    shares = np.frombuffer(b"".join([bytes(r["terms"]) for r in got]), np.float32).reshape(-1, TERMS)
    return fit_knn(shares, np.array([r["label"] for r in got], np.int64))


def with_scores(docs: DataFrame, scores_of, score_col: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the scores of ``scores_of(list of bytes)``, within the
    scan. ``scores_of`` is sent to the tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(scores_of)
    kept = [c for c in docs.columns if c.lower() != score_col.lower()]
    at = kept.index(text_col)
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields] + [f"`{score_col}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).cast(pa.binary()).to_pylist()
            scores = []
            for group in batched(texts, lambda t: len(t or b""), 4 << 20):
                scores.append(shared.value([t or b"" for t in group]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(scores) if scores else [],
                                                                   pa.float64())], names=[*kept, score_col])

    return rows.mapInArrow(run, ddl)


def score_quality(docs: DataFrame, model: KnnModel) -> DataFrame:
    """``docs`` with ``score``: the likelihood of label 1."""
    return with_scores(docs, model.scores)
