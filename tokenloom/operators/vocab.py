"""B2/B3 with a user-supplied vocabulary (plug point).

The byte tokenizer is native. A real vocabulary runs as Arrow batches in
``mapInArrow``, cut into slices of bounded size; the tokenizer is built once
per Python worker from the user's factory. Only the text -> ids step is Python: truncation, padding,
labels and masks stay native expressions on the returned id column.

A tokenizer is any object with ``encode_batch(list[str]) -> list[list[int]]``
that maps the special strings inside a text to their ids. To turn replies
into text (J4) it also has ``decode_batch(list[list[int]]) -> list[str]``,
which leaves special ids out.
"""

from __future__ import annotations

from typing import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from ..fixed import BYTE_OFFSET, SPECIAL_TOKENS
from ..functions.util import bounded_slices, worker_instance


def tokenize_column(df: DataFrame, text_col: str, tokenizer_factory: Callable,
                    out_col: str = "_tok", max_tokens: int | None = None) -> DataFrame:
    """Add ``out_col`` = ids of ``text_col`` (cut to ``max_tokens``)."""
    schema = StructType(list(df.schema.fields)).add(out_col, ArrayType(IntegerType()))
    limit = int(max_tokens) if max_tokens is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = worker_instance(tokenizer_factory)
        for whole in batches:
            for b in bounded_slices(whole, text_col):
                ids = tok.encode_batch(["" if t is None else t for t in b.column(text_col).to_pylist()])
                if limit is not None:
                    ids = [x[:limit] for x in ids]
                yield b.append_column(out_col, pa.array(ids, type=pa.list_(pa.int32())))

    return df.mapInArrow(run, schema)


def detokenize_column(df: DataFrame, ids_col: str, tokenizer_factory: Callable, out_col: str) -> DataFrame:
    """Add ``out_col`` = text of the ids in ``ids_col``; null ids are none."""
    schema = StructType(list(df.schema.fields)).add(out_col, StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = worker_instance(tokenizer_factory)
        for whole in batches:
            for b in bounded_slices(whole, ids_col):
                ids = [x or [] for x in b.column(ids_col).to_pylist()]
                yield b.append_column(out_col, pa.array(tok.decode_batch(ids), type=pa.string()))

    return df.mapInArrow(run, schema)


def marker_ids(tokenizer_factory: Callable, text: str) -> list[int]:
    """Driver-side ids of a marker string (B9), computed once."""
    return list(tokenizer_factory().encode_batch([text])[0])


class ByteTokenizer:
    """Python twin of the native byte tokenizer (for checks and as an
    example of the plug interface)."""

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        import re
        pat = re.compile("(" + "|".join(re.escape(s) for s in SPECIAL_TOKENS) + ")")
        out = []
        for t in texts:
            ids: list[int] = []
            for piece in pat.split(t):
                if piece in SPECIAL_TOKENS:
                    ids.append(SPECIAL_TOKENS[piece])
                elif piece:
                    ids.extend(b + BYTE_OFFSET for b in piece.encode("utf-8"))
            out.append(ids)
        return out

    def decode_batch(self, ids: list[list[int]]) -> list[str]:
        return [bytes(i - BYTE_OFFSET for i in x if i >= BYTE_OFFSET).decode("utf-8", "replace") for x in ids]


class HFTokenizer:
    """Adapter for a ``tokenizers`` JSON vocabulary file (optional package)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer  # gated: only needed with a vocabulary file
        self._tok = Tokenizer.from_file(path)

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tok.encode_batch(texts, add_special_tokens=False)]

    def decode_batch(self, ids: list[list[int]]) -> list[str]:
        return self._tok.decode_batch(ids, skip_special_tokens=True)
