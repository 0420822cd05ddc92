"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_table(df: DataFrame, path: str) -> None:
    """Write ``df`` as Parquet; its shuffle files go when it is written, not
    when the driver happens to collect its garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(key)
        else:
            conf.set(key, before)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (``lower`` would also change other letters)."""
    return F.translate(c, ASCII_UPPER, ASCII_UPPER.lower())


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def fold_column(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id has fold -1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod, F.lit(-1))


def batched(rows: Iterable[tuple], size_of, max_bytes: int) -> Iterator[list]:
    """Group rows so that a group holds about ``max_bytes`` at most; a single
    longer row is a group of its own."""
    group, held = [], 0
    for row in rows:
        n = size_of(row)
        if group and held + n > max_bytes:
            yield group
            group, held = [], 0
        group.append(row)
        held += n
    if group:
        yield group


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_ngrams(texts: list[bytes], n: int, buckets: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every byte n-gram that lies inside one text."""
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
    lens = np.array([len(t) for t in texts], np.int64)
    if len(data) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.full(len(data) - n + 1, salt, np.uint64)
    for j in range(n):
        code = code * np.uint64(0x100000001B3) + data[j:len(data) - n + 1 + j] + np.uint64(1)
    row = np.repeat(np.arange(len(texts)), lens)
    inside = row[:len(code)] == row[n - 1:]
    return row[:len(code)][inside], (mix64(code[inside]) % np.uint64(buckets)).astype(np.int64)


@dataclass(frozen=True)
class Runs:
    """Ranges of a long id, numbered in the order that is asked for; rows with
    a null id form the last run."""

    bounds: np.ndarray
    descending: bool

    @property
    def count(self) -> int:
        return len(self.bounds) + 2

    def of(self, ids: pd.Series) -> np.ndarray:
        """Run of each id. Equal ids have equal runs."""
        null = ids.isna().to_numpy()
        at = np.searchsorted(self.bounds, ids.fillna(0).astype("int64").to_numpy(), side="left")
        if self.descending:
            at = len(self.bounds) - at
        return np.where(null, len(self.bounds) + 1, at).astype(np.int32)

    def column(self, df: DataFrame, id_col: str) -> DataFrame:
        """Add the column ``run``."""
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("int")
        def run(ids: pd.Series) -> pd.Series:
            return pd.Series(shared.value.of(ids))

        return df.withColumn("run", run(id_col))

    def heads(self, df: DataFrame, id_col: str = "doc_id") -> dict[int, int | None]:
        """First id of each run that has rows (one row a run)."""
        first = F.max(id_col) if self.descending else F.min(id_col)
        numbered = self.column(df.select(id_col), id_col)
        return {r[0]: r[1] for r in numbered.groupBy("run").agg(first).collect()}


def id_runs(df: DataFrame, descending: bool = False, parts: int | None = None, id_col: str = "doc_id") -> Runs:
    """Cut the ids into about ``parts`` ranges of equal rows; only the bounds
    (one number a range) reach the driver."""
    parts = parts or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = df.select(F.percentile_approx(id_col, [i / parts for i in range(1, parts)], 100 * parts)).first()[0]
    return Runs(np.unique(np.array(cuts or [], np.int64)), descending)
