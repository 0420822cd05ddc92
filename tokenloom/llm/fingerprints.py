"""Document fingerprints: content-defined chunks and their digests.

A gear hash runs over the UTF-8 bytes; normalised boundaries use a strict
mask before the normal chunk size and a loose one after it. A fingerprint is
the sorted set of distinct chunk digests with the chunk lengths; the share of
its bytes that another fingerprint has too is the containment.

Cases: a null text counts as empty; the empty text has the empty fingerprint;
two empty fingerprints are alike (1.0), an empty and another one are not
(0.0). Ties of doc_id are ordered by the text's digest, null ids come last.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batched, id_runs, text_or_empty

MIN_CHUNK, NORMAL_CHUNK, MAX_CHUNK = 16, 40, 256
#: Boundary masks on the high bits of the 32-bit gear hash; each step shifts
#: it by two bits, so it covers the last 16 bytes.
STRICT_BITS, LOOSE_BITS = 6, 4
_TILE = 1 << 20
_DIGEST, _LENGTH = 12, 3  # hex digits of a chunk in a fingerprint

_GEAR = np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint32)


def boundaries(data: bytes, strict_bits: int, loose_bits: int) -> tuple[list[int], list[int]]:
    """End positions with a strict and with a loose boundary. A hash covers
    the last 16 bytes, so tiles overlap by 15."""
    strict, loose = [], []
    raw = np.frombuffer(data, np.uint8)
    for start in range(0, len(raw), _TILE):
        lead = min(start, 15)
        h = _GEAR[raw[start - lead:start + _TILE]]
        for span in (1, 2, 4, 8):
            if len(h) > span:
                h[span:] += h[:-span] << np.uint32(2 * span)
        h = h[lead:]
        at = np.flatnonzero(h >> np.uint32(32 - loose_bits) == 0)
        strict += (at[h[at] >> np.uint32(32 - strict_bits) == 0] + (start + 1)).tolist()
        loose += (at + (start + 1)).tolist()
    return strict, loose


def chunk_ends(data: bytes, least: int = MIN_CHUNK, normal: int = NORMAL_CHUNK, most: int = MAX_CHUNK,
               strict_bits: int = STRICT_BITS, loose_bits: int = LOOSE_BITS) -> list[int]:
    """End offsets of the chunks of one text. With ``least`` of 16 or more, no
    hash that is used covers bytes before its chunk."""
    strict, loose = boundaries(data, strict_bits, loose_bits)
    out, start, n = [], 0, len(data)
    i = j = 0
    while n - start > least:
        mid, high = start + normal, min(start + most, n)
        j = bisect_left(strict, start + least, j)
        if j < len(strict) and strict[j] < mid:
            end = strict[j]
        else:
            i = bisect_left(loose, mid, i)
            end = loose[i] if i < len(loose) and loose[i] < high else high
        out.append(end)
        start = end
    if start < n:
        out.append(n)
    return out


def chunk_set(data: bytes) -> dict[int, int]:
    """Digest (48 bits) to length of each distinct chunk."""
    digest, out, start = xxhash.xxh3_64_intdigest, {}, 0
    for end in chunk_ends(data):
        out[digest(data[start:end]) & 0xFFFFFFFFFFFF] = end - start
        start = end
    return out


def to_string(chunks: dict[int, int]) -> str:
    return "".join([f"{d:012x}{n:03x}" for d, n in sorted(chunks.items())])


def from_string(fingerprint: str) -> dict[int, int]:
    w = _DIGEST + _LENGTH
    return {int(fingerprint[i:i + _DIGEST], 16): int(fingerprint[i + _DIGEST:i + w], 16)
            for i in range(0, len(fingerprint), w)}


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Share of the bytes in the distinct chunks of ``a`` that ``b`` has too."""
    if not a:
        return 1.0 if not b else 0.0
    both = sum([n for d, n in a.items() if d in b])
    return both / sum(a.values())


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row, within the scan."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = [to_string(chunk_set((t or "").encode())) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints, pa.string())], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, fp string")
            .toDF(id_col, "fingerprint"))


# -- each document with its neighbour in descending id order -----------------

def in_sorted_runs(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """(run, edge, doc_id, text): documents in ranges of descending doc_id, one
    run after the other, each in order. The head of the next run ends each run
    with ``edge`` true, so that a run's last row finds its successor. Only the
    bounds and heads of the runs (one row a run) reach the driver."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    runs = id_runs(rows, descending=True, parts=parts)
    heads = runs.heads(rows)
    order = sorted(heads)
    before = {run: order[i - 1] for i, run in enumerate(order)}  # the first head goes to the last run
    shared = rows.sparkSession.sparkContext.broadcast((runs, heads, before))

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        runs, heads, before = shared.value
        null = ids.isna().to_numpy()
        return pd.Series([[int(r), before[r]] if (heads[r] is None and n) or (not n and heads[r] == i) else [int(r)]
                          for r, i, n in zip(runs.of(ids), ids, null)], dtype=object)

    placed = rows.select(F.posexplode(places("doc_id")).alias("edge", "run"), "doc_id", "text")
    placed = placed.select("run", (F.col("edge") == 1).alias("edge"), "doc_id", "text")
    return (placed.withColumn("tie", F.xxhash64("text"))
            .repartitionById(runs.count, F.col("run"))
            .sortWithinPartitions("run", "edge", F.desc_nulls_last("doc_id"), "tie", "text"))


def edited_text(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double")


def compare_neighbours(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprint every document, its edited text and compare them with each
    other and with the next document (descending doc_id, the first after the
    last)."""
    def one(cur, nxt):
        doc_id, text, chunks = cur
        edited = edited_text(text, nxt[1]).encode()
        other = chunk_set(edited)
        return (doc_id, len(text), hashlib.sha256(edited).hexdigest(), to_string(chunks),
                to_string(other), containment(chunks, other), containment(chunks, nxt[2]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                            ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                            ("near_edited", pa.float64()), ("near_next", pa.float64())])

        def rows():
            for b in batches:
                yield from zip(*[c.to_pylist() for c in b.columns])

        def results():
            held = None  # (run, edge, (doc_id, text, chunks))
            for run_no, edge, doc_id, text in rows():
                if held and held[0] != run_no:
                    held = None
                if held and held[1]:
                    continue  # further copies of an edge
                cur = (doc_id, text, chunk_set(text.encode()))
                if held:
                    yield one(held[2], cur)
                held = (run_no, edge, cur)

        for group in batched(results(), lambda r: 200 + len(r[3]) + len(r[4]), 4 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*group), schema)],
                                             schema=schema)

    ordered = in_sorted_runs(docs, parts).select("run", "edge", "doc_id", "text")
    return ordered.mapInArrow(run, _OUT)
