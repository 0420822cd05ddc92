"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all other texts of the fold, whatever
their labels, are unlabelled. A linear model over the hashed distinct words
of a text and their beginnings (those that a test finds more often in the
positives) minimises the class-prior-corrected risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

with the logistic loss; where the corrected negative risk is below zero, the
step goes up that part's gradient instead.

Cases: a null text counts as empty; the empty text has the score of the bias
alone. Without positives (or unlabelled texts) every score is the prior, 0
without labelled rows. Null labels aren't learned. Repeated rows get equal
scores; columns of the input are kept unless they are named like an output
column.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_column, text_or_empty
from .quality_knn import labelled_sample, with_scores

#: Bounds on the texts that are fitted, and on the distinct words of each.
MAX_POSITIVE, MAX_UNLABELLED = 2000, 6000
BUCKETS = 1 << 18
LEAST_TEXTS = 4  # a word must occur in so many fitted texts
LEAST_DEVIATIONS = 4.5  # of a word's share in positives from that in others
PREFIXES = (4, 5, 6)  # bytes
_WORD = re.compile(rb"[a-z\x80-\xff]+")


def word_buckets(text: bytes) -> np.ndarray:
    """Hash buckets of the distinct words, A-Z lower-cased, and of their first
    letters, which inflected forms share."""
    crc = zlib.crc32
    words = set(_WORD.findall(text.lower()))
    codes = [crc(w) for w in words]
    for n in PREFIXES:
        codes += [crc(w, n) for w in {w[:n] for w in words if len(w) > n}]
    return np.unique(np.array(codes, np.int64) % BUCKETS)


@dataclass
class PuModel:
    weights: np.ndarray  # BUCKETS
    bias: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        z = np.array([self.weights[word_buckets(t)].sum() for t in texts]) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


class _Rows:
    """Sparse 0/1 rows over the chosen words."""

    def __init__(self, rows: list[np.ndarray]):
        self.n = len(rows)
        self.col = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])

    def values(self, w: np.ndarray, b: float) -> np.ndarray:
        return np.bincount(self.row, w[self.col], minlength=self.n) + b

    def gradient(self, d: np.ndarray, size: int) -> np.ndarray:
        """Gradient of (weights, bias) for derivatives ``d`` of the rows."""
        return np.append(np.bincount(self.col, d[self.row], minlength=size), d.sum())


def telling_words(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Buckets that positives hold more often than unlabelled texts, by a
    two-sample test of their shares."""
    p, u = (np.bincount(np.concatenate(x), minlength=BUCKETS) for x in (positive, unlabelled))
    n_p, n_u = len(positive), len(unlabelled)
    share = (p + u) / (n_p + n_u)
    deviation = np.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u)) + 1e-12
    return np.flatnonzero((p + u >= LEAST_TEXTS) & ((p / n_p - u / n_u) / deviation > LEAST_DEVIATIONS))


def fit_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = 300,
             rate: float = 0.05, shrink: float = 0.3) -> PuModel:
    """Full-batch Adam on the non-negative risk over the telling words.
    ``positive`` and ``unlabelled`` are word buckets of texts; the squared
    weights' penalty is ``shrink`` by the number of positives."""
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    bias = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return PuModel(np.zeros(BUCKETS), bias)
    chosen = telling_words(positive, unlabelled)
    place = np.full(BUCKETS, -1)
    place[chosen] = np.arange(len(chosen))
    p, u = (_Rows([r[r >= 0] for r in (place[x] for x in rows)]) for rows in (positive, unlabelled))
    size, l2 = len(chosen), shrink / len(positive)
    theta = np.zeros(size + 1)
    theta[-1] = bias
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1):
        w, b = theta[:-1], theta[-1]
        zp, zu = p.values(w, b), u.values(w, b)
        # The logistic loss: log(1 + exp(-z)) for the label +, log(1 + exp(z)) for -.
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        g_plus = p.gradient(-prior * _sigmoid(-zp) / p.n, size)
        g_minus = u.gradient(_sigmoid(zu) / u.n, size) - p.gradient(prior * _sigmoid(zp) / p.n, size)
        g = g_plus + g_minus if negative >= 0 else -g_minus
        g[:-1] += l2 * w
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        theta = theta - rate * (1 - t / (steps + 1)) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    weights = np.zeros(BUCKETS)
    weights[chosen] = theta[:-1]
    return PuModel(weights, float(theta[-1]))


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE,
                 max_unlabelled: int = MAX_UNLABELLED, label: str = "toxic", fold: int = 5,
                 held_out: int = 0) -> PuModel:
    """Fit on the rows whose crc32 fold isn't ``held_out``; the class prior is
    the share of toxic rows among the labelled ones. Words are hashed in the
    tasks; the bounded sample's buckets reach the driver."""
    in_fold = fold_column(F.col("doc_id"), fold) != held_out
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(in_fold)
    prior = known.agg(F.avg("y")).first()[0]
    positive = labelled_sample(docs, labels, label, in_fold & (F.col("label") == 1), max_positive)
    toxic_ids = positive.select("doc_id")

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t in zip(*[c.to_pylist() for c in b.columns]):
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([word_buckets(t.encode())
                                                 .astype(np.int32).tobytes()])], names=["doc_id", "words"])

    # Unlabelled: the texts of the fold with the smallest hashes of id and text.
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
            .where(F.col("doc_id").isNotNull() & in_fold))
    ids = (rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(max_unlabelled))
    others = rows.join(F.broadcast(ids), "doc_id")  # ``max_unlabelled`` rows

    def collected(df: DataFrame, limit: int) -> list[np.ndarray]:
        got = df.select("doc_id", "text").mapInArrow(buckets, "doc_id long, words binary").collect()
        got.sort(key=lambda r: (r["doc_id"], bytes(r["words"])))
        return [np.frombuffer(bytes(r["words"]), np.int32).astype(np.int64) for r in got[:limit]]

    return fit_nnpu(collected(positive, max_positive), collected(others, max_unlabelled), float(prior or 0.0))


def score_toxicity(docs: DataFrame, model: PuModel) -> DataFrame:
    """``docs`` with ``score``: the likelihood of being toxic."""
    return with_scores(docs, model.scores)
