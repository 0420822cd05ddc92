"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash cuts each text into chunks of some hundred bytes. A chunk that
documents share is encoded once as long as a task remembers it. The ids
near a chunk's ends depend on its neighbours, so each chunk keeps its ids
between its first and last space only (white space always ends a token of
this vocabulary), and every join is repaired by re-encoding the text from the
last space of the one chunk to the first space of a following one. There the
re-encoded ids agree exactly with the kept ones on both sides; if a chunk has
no space, the repaired stretch grows over it until one is found.

Cases: a null text counts as empty and has no ids; rows with equal ids or
texts are treated alike; extra columns are kept unless they have the name of
an output column; those are replaced.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .fingerprints import chunk_ends
from .memo import PieceMemo, load_tokenizer, lower_case_words

CHUNKING = {"least": 128, "normal": 256, "most": 2048, "strict_bits": 9, "loose_bits": 6}
CHUNK_LIMIT = 30_000  # chunks that a task remembers
SLICE_BYTES = 1 << 20  # of texts that are Python objects at a time


class Encoded(NamedTuple):
    """Ids as decimal text, the decoded text (both joined by one space)."""

    n: int
    ids: str
    text: str


#: Parts of a text are plain tuples of the same fields: they are many, and
#: Python's collector of cycles looks at named ones again and again.
Part = tuple[int, str, str]
EMPTY: Part = (0, "", "")


class Chunk:
    """A chunk's text up to its first space, its encoded middle, and its text
    after the last space; ``tail`` is None without a space."""

    __slots__ = ("head", "tail", "middle", "used")

    def __init__(self, data: bytes):
        text = data.decode()
        first, last = text.find(" "), text.rfind(" ")
        self.used = False
        if first < 0:
            self.head, self.tail, self.middle = text, None, EMPTY
        else:
            self.head, self.tail = text[:first], text[last + 1:]
            self.middle = text[first + 1:last].split(" ") if last > first else EMPTY


def join(parts: list[Part]) -> Part:
    parts = [p for p in parts if p[0]]
    if len(parts) == 1:
        return parts[0]
    return (sum([n for n, _, _ in parts]), " ".join([ids for _, ids, _ in parts]),
            " ".join([text for _, _, text in parts]))


def text_chunks(text: str) -> list[bytes]:
    """Content-defined chunks, moved to the ends of characters."""
    data, out, start = text.encode(), [], 0
    for end in chunk_ends(data, **CHUNKING):
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        if end > start:
            out.append(data[start:end])
            start = end
    return out


class ChunkEncoder:
    """Encode whole texts as the library does, chunk by chunk."""

    def __init__(self, path: str, chunk_limit: int = CHUNK_LIMIT):
        tokenizer = load_tokenizer(path)
        if tokenizer.decoder is not None:
            raise ValueError("the vocabulary must decode by joining tokens with spaces")
        names = [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size())]
        decimal = [str(i) for i in range(len(names))]

        def part(ids: list[int]) -> Part:
            if len(ids) == 1:
                return 1, decimal[ids[0]], names[ids[0]]
            return len(ids), " ".join([decimal[i] for i in ids]), " ".join([names[i] for i in ids])

        self.words = PieceMemo(tokenizer, lower_case_words, part, join, limit=150_000)
        self.chunks: dict[bytes, Chunk] = {}
        self.chunk_limit, self.reused, self.seen = chunk_limit, 0, 0

    def forget(self) -> None:
        """Drop all that is remembered; the vocabulary stays."""
        self.words.forget()
        self.chunks = {}

    def _chunk(self, data: bytes, new: list[Chunk]) -> Chunk:
        self.seen += 1
        found = self.chunks.get(data)
        if found is None:
            found = self.chunks[data] = Chunk(data)
            new.append(found)
        else:
            found.used = True
            self.reused += 1
        return found

    def encode(self, texts: list[str]) -> list[Encoded]:
        if len(self.chunks) > self.chunk_limit:  # keep what was shared since the last time
            self.chunks = {k: c for k, c in self.chunks.items() if c.used}
            for c in self.chunks.values():
                c.used = False
        new: list[Chunk] = []
        plans, needed = [], set()
        for text in texts:
            plan, pending = [], ""
            for chunk in [self._chunk(data, new) for data in text_chunks(text)]:
                if chunk.tail is None:
                    pending += chunk.head
                    continue
                plan.append(pending + chunk.head)  # the repaired join
                plan.append(chunk)
                pending = chunk.tail
            plan.append(pending)
            needed.update(plan[::2])
            plans.append(plan)
        for chunk in new:
            if type(chunk.middle) is list:
                needed.update(chunk.middle)
        self.words.learn(needed)
        word = self.words.__getitem__
        for chunk in new:
            if type(chunk.middle) is list:
                chunk.middle = join(list(map(word, chunk.middle)))
        return [Encoded(*join([word(p) if type(p) is str else p.middle for p in plan])) for plan in plans]


_ENCODERS: dict[str, ChunkEncoder] = {}


def chunk_encoder(path: str) -> ChunkEncoder:
    """One encoder a Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def slices(b: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Rows whose texts (the last column) have about ``most`` bytes together; a
    longer one is a slice of its own."""
    sizes = pc.binary_length(b.column(b.num_columns - 1)).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < b.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + most, "right")))
        yield b.slice(at, end - at)
        at = end


def _encode(docs: DataFrame, tokenizer_path: str, fields: list[tuple[str, pa.DataType, str]],
            row_of: Callable[[Encoded], tuple], text_col: str) -> DataFrame:
    """Replace ``text_col`` by the fields that ``row_of`` makes."""
    names = {f[0].lower() for f in fields}
    kept = [c for c in docs.columns if c != text_col and c.lower() not in names]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], text_or_empty(text_col).alias("__text"))
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
                    + [f"{n} {sql}" for n, _, sql in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(tokenizer_path)
        gc.disable()  # what is remembered has no cycles, and looking for them takes long
        try:
            for b in batches:
                for part in slices(b, SLICE_BYTES):
                    made = list(zip(*[row_of(e) for e in encoder.encode(part.column(len(kept)).to_pylist())]))
                    columns = [part.column(i) for i in range(len(kept))]
                    columns += [pa.array(c, t) for c, (_, t, _) in zip(made, fields)]
                    yield pa.RecordBatch.from_arrays(columns, names=kept + [f[0] for f in fields])
        finally:
            encoder.forget()  # the worker stays, for other work too
            gc.enable()
            gc.collect()
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, ddl)


def _digests(e: Encoded) -> tuple:
    return (e.n, hashlib.sha256(e.ids.encode()).hexdigest(), hashlib.sha256(e.text.encode()).hexdigest())


_DIGESTS = [("n_tokens", pa.int64(), "bigint"), ("ids_sha256", pa.string(), "string"),
            ("decoded_sha256", pa.string(), "string")]


def encode_documents(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, then ids, n_tokens, ids_sha256 and
    decoded_sha256."""
    def row_of(e: Encoded) -> tuple:
        return (np.array(e.ids.split(), np.int32) if e.n else np.zeros(0, np.int32), *_digests(e))

    return _encode(docs, tokenizer_path, [("ids", pa.list_(pa.int32()), "array<int>"), *_DIGESTS], row_of, text_col)


def decode_documents(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, then n_tokens and the text that
    its ids decode to."""
    return _encode(docs, tokenizer_path, [("n_tokens", pa.int64(), "bigint"), ("decoded", pa.string(), "string")],
                   lambda e: (e.n, e.text), text_col)


def encoding_digests(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, then n_tokens, ids_sha256 and
    decoded_sha256."""
    return _encode(docs, tokenizer_path, _DIGESTS, _digests, text_col)
