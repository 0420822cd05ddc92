"""URL filter: rules first, then logistic regression on hashed character
n-grams of host and path, trained from a small labelled URL table.

Cases: a null url or one without ``://`` has an empty host and path, matches
no rule and is judged by the model (its score is the model's bias alone).
Repeated urls get equal verdicts. Extra columns are kept unless they have the
name of an output column; those are replaced. An empty labelled table, or one
with a single class, gives a constant model (``allow`` when there is none).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, byte_ngrams

#: (host, path, verdict); a rule fits its host and all subdomains.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

BUCKETS = 1 << 14
GRAM_SIZES = (3, 4, 5)
#: Bound on the labelled rows that are fitted, and on the length of their urls.
MAX_LABELLED = 4096
MAX_LABELLED_URL = 2048


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))
    return ascii_lower(host), path


def rule_columns(host: Column, path: Column,
                 rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text and its verdict; null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def url_features(hosts: Sequence[str], paths: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (row, bucket, value); each row has length one."""
    rows, cols = [], []
    for part, values in enumerate((hosts, paths)):
        marked = [b"\x02" + v.encode() + b"\x03" if v else b"" for v in values]
        for n in GRAM_SIZES:
            r, c = byte_ngrams(marked, n, BUCKETS, salt=17 * part + n)
            rows.append(r)
            cols.append(c)
    key = np.unique(np.concatenate(rows) * BUCKETS + np.concatenate(cols))
    row, col = key // BUCKETS, key % BUCKETS
    count = np.bincount(row, minlength=len(hosts))
    return row, col, 1.0 / np.sqrt(count[row])


@dataclass
class UrlModel:
    weights: np.ndarray
    bias: float

    def block_probability(self, hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
        row, col, val = url_features(hosts, paths)
        z = np.bincount(row, self.weights[col] * val, minlength=len(hosts)) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def fit_urls(hosts: Sequence[str], paths: Sequence[str], blocked: np.ndarray,
             steps: int = 300, l2: float = 1e-4, rate: float = 0.1) -> UrlModel:
    """Class-weighted logistic regression by full-batch Adam."""
    y = np.asarray(blocked, float)
    if len(y) == 0 or y.min() == y.max():
        return UrlModel(np.zeros(BUCKETS), 0.0 if len(y) == 0 else (4.0 if y[0] else -4.0))
    row, col, val = url_features(hosts, paths)
    per_row = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w, b = np.zeros(BUCKETS), 0.0
    m, v = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for t in range(1, steps + 1):
        z = np.bincount(row, w[col] * val, minlength=len(y)) + b
        err = (1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - y) * per_row
        g = np.append(np.bincount(col, err[row] * val, minlength=BUCKETS) + l2 * w, err.sum())
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return UrlModel(w, float(b))


def fit_url_model(labelled: DataFrame, limit: int = MAX_LABELLED) -> UrlModel:
    """Fit on ``labelled`` (host, path, verdict). At most ``limit`` distinct
    rows are used, those with the smallest hashes."""
    sample = (labelled.where(F.col("verdict").isin("allow", "block")
                             & (F.length("host") + F.length("path") <= MAX_LABELLED_URL))
              .select("host", "path", "verdict").distinct()
              .orderBy(F.xxhash64("host", "path"), "host", "path", "verdict").limit(limit).toPandas())
    return fit_urls(sample["host"].tolist(), sample["path"].tolist(),
                    (sample["verdict"] == "block").to_numpy())


def with_rules(pages: DataFrame, rules=RULES, url_col: str = "url") -> DataFrame:
    """Add host, path, rule and rule_verdict."""
    host, path = url_parts(F.col(url_col))
    out = pages.withColumns({"host": host, "path": path})
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    return out.withColumns({"rule": rule, "rule_verdict": verdict})


def filter_urls(pages: DataFrame, model: UrlModel, rules=RULES, url_col: str = "url",
                threshold: float = 0.5) -> DataFrame:
    """Add host, path, rule, verdict and block_score to ``pages``."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for host, path in batches:
            yield pd.Series(shared.value.block_probability(host.tolist(), path.tolist()))

    judged = with_rules(pages, rules, url_col).withColumn("block_score", score("host", "path"))
    by_model = F.when(F.col("block_score") >= threshold, "block").otherwise("allow")
    return (judged.withColumn("verdict", F.coalesce(F.col("rule_verdict"), by_model))
            .drop("rule_verdict"))
