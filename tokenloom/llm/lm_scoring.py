"""Scores of a trigram language model that is learned from the whole corpus.

The model interpolates along contexts, with all counts from the training
documents:

    P1(w)      = (c(w) + 0.5) / (N + 0.5 (V + 1))
    P2(w|v)    = (c(vw) + k2 P1(w)) / (c(v) + k2),     k2 = 3 c(v) ** 0.9
    P3(w|u,v)  = (c(uvw) + k3 P2(w|v)) / (c(uv) + k3), k3 = 2 c(uv) ** 0.9

with P3 = P2 for contexts (u, v) seen less than ``least_context`` times (1 in
the registered query: all that were seen count) and P2 = P1 for an unseen v; so each context's probabilities add up to one (all
unknown words counting as one). A text starts after two start marks and ends
with the end token.

How it runs: texts are cut into chunks of about ``CHUNK_TOKENS`` tokens, kept
as compact files in the shared folder. A chunk asks for each distinct word
(then pair, then triple) once; requests are dealt by hash to shards as sorted
arrays, so no key is hot: a word, pair or triple has one entry a chunk at
most. Shards add up the training counts and reply. A shard of triples writes
an Elias-Fano trie (``elias_fano.Trie``) with quantised probabilities and
back-offs, memory-maps it and answers by successor search in the context's
range; a context that holds much of a shard is dealt by its third word, too.
Shards and chunks are bounded, and their number grows with the corpus. The
shuffle files of a step go as soon as its replies are written.

Cases: a null text counts as empty: its one token is the end. A null doc_id
is learned from and never held out. Rows may repeat; each is learned from and
scored. A text longer than a chunk is cut into segments that overlap by their
context and its sums are added up. Without training texts all counts are 0.
Other columns play no part.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from .common import fold_column, mix64, text_or_empty, write_table
from .elias_fano import Trie

CHUNK_TOKENS = 1 << 20
SHARD_ENTRIES = 1 << 21
LEAST_CONTEXT = 2  # the default of ``least_context``; 1 leaves no context out
K2, K3, POWER = 3.0, 2.0, 0.9
#: Probabilities are kept as -log10 in steps of 1 / STEPS, up to 16.
STEPS = 4095
P2_BITS = 5  # low bits that are left out of P2 on its way to a shard
_START, _END = b" s", b" e"  # keys of the marks; no word holds a space


# -- compact arrays -----------------------------------------------------------

def pack(values: np.ndarray, delta: bool = False) -> bytes:
    """Compressed array; ``delta`` for sorted integers."""
    values = np.asarray(values)
    if delta and len(values):
        values = np.diff(values, prepend=values.dtype.type(0))
    if values.dtype.kind in "ui" and len(values):
        small = np.min_scalar_type(int(values.max())) if values.min() >= 0 else values.dtype
        values = values.astype(small)
    raw = values.view(np.uint8).reshape(len(values), -1).T.tobytes() if len(values) else b""
    head = np.array([len(values)], "<i8").tobytes() + values.dtype.str.encode().ljust(4) + bytes([delta])
    return head + zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(data: bytes, kind=np.int64) -> np.ndarray:
    n, dtype, delta = int(np.frombuffer(data, "<i8", 1)[0]), data[8:12].decode().strip(), data[12]
    raw = zstandard.ZstdDecompressor().decompress(data[13:])
    size = np.dtype(dtype).itemsize
    out = np.frombuffer(raw, np.uint8).reshape(size, n).T.copy().view(dtype).reshape(n) if n else np.zeros(0, dtype)
    out = out.astype(kind)
    return np.cumsum(out, dtype=kind) if delta else out


def frame(parts: list[bytes]) -> bytes:
    return b"".join([len(p).to_bytes(8, "little") + p for p in parts])


def unframe(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at:at + 8], "little")
        out.append(data[at + 8:at + 8 + n])
        at += 8 + n
    return out


def quantise(p: np.ndarray) -> np.ndarray:
    """Code of a probability, 1 or more."""
    return np.clip(np.rint(-np.log10(np.maximum(p, 1e-16)) * STEPS), 0, 65534).astype(np.uint16) + np.uint16(1)


def log10_of(code: np.ndarray) -> np.ndarray:
    return -(code.astype(np.float64) - 1) / STEPS


# -- files in the shared folder --------------------------------------------------

class Folder:
    """Read and write small files below a path of the shared storage."""

    def __init__(self, path: str):
        self.fs, self.path = pafs.FileSystem.from_uri(path)

    def write(self, name: str, data: bytes) -> None:
        """The file appears whole: it is written under another name first."""
        self.fs.create_dir(self.path, recursive=True)
        other = f"{self.path}/.{name}.{uuid.uuid4().hex[:8]}"
        with self.fs.open_output_stream(other) as f:
            f.write(data)
        self.fs.move(other, f"{self.path}/{name}")

    def read(self, name: str) -> bytes:
        with self.fs.open_input_stream(f"{self.path}/{name}") as f:
            return f.read()

    def view(self, name: str):
        """Memory-mapped where the storage is mounted, else read."""
        if isinstance(self.fs, pafs.LocalFileSystem):
            return np.memmap(f"{self.path}/{name}", np.uint8, "r")
        return self.read(name)


# -- chunks ------------------------------------------------------------------------

class ChunkWriter:
    """Gather segments of texts and write them as chunk files.

    A segment has two tokens of context and then its tokens. A text's further
    segments begin with the last token of the segment before, as a repeated
    token that isn't counted, so that its pair is known as a context.
    """

    def __init__(self, folder: Folder, size: int):
        self.folder, self.size, self.made = folder, size, []
        self.clear()

    def clear(self) -> None:
        self.codes: dict[bytes, int] = {}
        self.places: list[np.ndarray] = []
        self.segments: list[tuple] = []  # row, doc_id, null, held out, tokens, repeated
        self.held = self.texts = 0

    def _place(self, words: list[bytes]) -> np.ndarray:
        codes = self.codes
        size = len(codes)
        for w in set(words).difference(codes):
            codes[w] = size
            size += 1
        return np.fromiter(map(codes.__getitem__, words), np.int32, len(words))

    def add(self, row: int, doc_id: int | None, held_out: bool, text: bytes) -> None:
        words = [_START, _START, *text.lower().split(), _END]
        for at in range(2, len(words), self.size):
            repeated = int(at > 2)
            part = words[at - 2 - repeated:at + self.size]
            self.places.append(self._place(part))
            self.segments.append((row, doc_id or 0, doc_id is None, held_out, len(part) - 2, repeated))
            self.held += len(part)
            if at + self.size >= len(words):
                self.texts += not held_out
            if self.held >= self.size:
                self.flush()

    def flush(self) -> None:
        if not self.segments:
            return
        keys = list(self.codes)
        code = np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))
        order = np.argsort(code)
        place = np.empty(len(keys), np.int32)
        place[order] = np.arange(len(keys))
        tokens = place[np.concatenate(self.places)]
        row, doc, null, held, n, repeated = (np.array(x, np.int64) for x in zip(*self.segments))
        name = uuid.uuid4().hex
        self.folder.write(name, frame([pack(code[order], delta=True), pack(tokens), pack(row), pack(doc), pack(null),
                                       pack(held), pack(n), pack(repeated)]))
        counted = n - repeated
        self.made.append((name, int(counted.sum()), int(counted[held == 0].sum()), self.texts))
        self.clear()


START_CODE = np.uint64(xxhash.xxh3_64_intdigest(_START))
_MADE = "chunk string, tokens long, learned long, texts long"


class Chunk:
    """A chunk's words and positions: tokens with the two before."""

    def __init__(self, folder: Folder, name: str):
        code, tokens, row, doc, null, held, n, repeated = unframe(folder.read(name))
        self.code, tokens = unpack(code, np.uint64), unpack(tokens, np.int32)
        self.row, self.doc, self.n = unpack(row), unpack(doc), unpack(n)
        self.null, self.held, self.repeated = unpack(null, bool), unpack(held, bool), unpack(repeated)
        self.segment = np.repeat(np.arange(len(self.n), dtype=np.int32), self.n)
        at = np.arange(len(self.segment), dtype=np.int64) + 2 * (self.segment.astype(np.int64) + 1)
        self.w, self.v, self.u = tokens[at], tokens[at - 1], tokens[at - 2]
        self.first = np.ones(len(at), bool)
        self.first[1:] = self.segment[1:] != self.segment[:-1]
        self.counted = ~(self.first & (self.repeated[self.segment] > 0))
        self.learned = self.counted & ~self.held[self.segment]


def distinct(key: np.ndarray, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, each position's place, training counts."""
    keys, place = np.unique(key, return_inverse=True)
    return keys, place, np.bincount(place, learned, minlength=len(keys)).astype(np.int64)


def kappa(k: float, c: np.ndarray) -> np.ndarray:
    return k * np.power(c, POWER, dtype=np.float64)


# -- requests and replies -------------------------------------------------------------

_REQUEST = "shard int, chunk string, payload binary"
_REPLY = "chunk string, shard int, payload binary"


def batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "long": pa.int64(),
             "double": pa.float64(), "boolean": pa.bool_()}
    fields = [f.split() for f in ddl.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)],
                                      names=[n for n, _ in fields])


def pack_counts(key: np.ndarray, count: np.ndarray) -> bytes:
    """Sorted keys and their counts."""
    return frame([pack(key, delta=True), pack(count)])


def pack_triples(uv, w, learned, context, p2) -> bytes:
    """Entries sorted by (uv, w); what belongs to a context is there once."""
    new = np.ones(len(uv), bool)
    new[1:] = uv[1:] != uv[:-1]
    run = np.diff(np.append(np.flatnonzero(new), len(uv)))
    return frame([pack(uv[new], delta=True), pack(run), pack(context[new]), pack(w), pack(learned), pack(p2)])


def unpack_triples(data: bytes) -> tuple[np.ndarray, ...]:
    uv, run, context, w, learned, p2 = unframe(data)
    run = unpack(run)
    return (np.repeat(unpack(uv, np.uint64), run), unpack(w), unpack(learned), np.repeat(unpack(context), run),
            unpack(p2))


def requests(chunk: str, shard: np.ndarray, columns: list[np.ndarray], pack_part=pack_counts) -> Iterator[pa.RecordBatch]:
    """One row for each shard that a chunk has entries for (at least one).
    Entries keep their order within a shard."""
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for part in np.split(order, cuts) if len(order) else [order]:
        number = int(shard[part[0]]) if len(part) else 0
        yield batch([(number, chunk, pack_part(*[c[part] for c in columns]))], _REQUEST)


def replies_in_order(rows: dict[int, bytes], shard: np.ndarray) -> np.ndarray:
    """A chunk's replies, back in the order of its entries."""
    order = np.argsort(shard, kind="stable")
    out = np.zeros(len(shard), np.int64)
    got = [unpack(rows[s]) for s in sorted(rows)]
    joined = np.concatenate(got) if got else np.zeros(0, np.int64)
    out[order] = joined[:len(order)]
    return out


def count_shard(with_ranks: bool):
    """A shard's answer: each entry's training count over all chunks and, if
    asked for, its rank among the known keys; then one row with the number of
    known keys and their sum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, keys, counts, number = [], [], [], 0
        for b in batches:
            number = b.column(0)[0].as_py()
            for chunk, payload in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                k, c = unframe(payload)
                chunks.append(chunk)
                keys.append(unpack(k, np.uint64))
                counts.append(unpack(c))
        if not chunks:
            return
        all_keys, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, np.concatenate(counts), minlength=len(all_keys)).astype(np.int64)
        ends = np.cumsum([len(k) for k in keys])
        rank = np.cumsum(total > 0) * (total > 0)
        for chunk, k, end in zip(chunks, keys, ends):
            at = place[end - len(k):end]
            yield batch([(chunk, number, frame([pack(total[at])] + [pack(rank[at])] * with_ranks))], _REPLY)
        yield batch([("", number, frame([pack(np.array([int((total > 0).sum()), int(total.sum())]))]))], _REPLY)

    return run


def learn_and_score(docs: DataFrame, fold: int = 5, held_out: int = 1, chunk_tokens: int = CHUNK_TOKENS,
                    shard_entries: int = SHARD_ENTRIES, model_dir: str | None = None,
                    least_context: int = LEAST_CONTEXT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    of every document; the tries stay below ``model_dir`` as shard files."""
    if least_context < 1:
        raise ValueError("an unseen context has no counts")
    spark = docs.sparkSession
    home = shared_path(spark, "lm")
    model_dir = model_dir or f"{home}/model"
    files = f"{home}/chunks"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (fold_column(F.col("doc_id"), fold) == held_out).alias("held_out"),
                       text_or_empty().alias("text"))

    def write_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ChunkWriter(Folder(files), chunk_tokens)
        row = TaskContext.get().partitionId() << 34
        for b in batches:
            texts = b.column(2).cast(pa.binary())
            for i, h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts):
                writer.add(row, i, h, t.as_py())
                row += 1
        writer.flush()
        if writer.made:
            yield batch(writer.made, _MADE)

    write_table(rows.mapInArrow(write_chunks, _MADE), f"{home}/manifest")
    manifest = spark.read.parquet(f"{home}/manifest")
    n_chunks, tokens, learned, texts = manifest.agg(
        F.count(F.lit(1)), *[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "learned", "texts")]).first()
    shards = max(1, -(-tokens // shard_entries))
    tasks = max(1, min(n_chunks, 4 * spark.sparkContext.defaultParallelism, 10_000))

    # Words.
    def shard_of_words(code: np.ndarray) -> np.ndarray:
        return ((code >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = Folder(files)
        for b in batches:
            for name in b.column(0).to_pylist():
                c = Chunk(folder, name)
                counts = np.bincount(c.w, c.learned, minlength=len(c.code)).astype(np.int64)
                yield from requests(name, shard_of_words(c.code), [c.code, counts])

    write_table(manifest.select("chunk").repartition(tasks).mapInArrow(ask_words, _REQUEST)
                .groupBy("shard").applyInArrow(count_shard(True), _REPLY), f"{home}/words")
    replies = spark.read.schema(_REPLY).parquet(f"{home}/words")
    known = {r["shard"]: unpack(unframe(bytes(r["payload"]))[0]) for r in replies.where("chunk = ''").collect()}
    sizes = np.zeros(shards, np.int64)  # one number a shard
    for s, x in known.items():
        sizes[s] = x[0]
    vocabulary = int(sizes.sum())
    if vocabulary >= (1 << 32) - 4:
        raise ValueError("word ids have 32 bits")
    first_id = np.concatenate([[0], np.cumsum(sizes)[:-1]]) + 2  # 0: unknown, 1: start mark
    n_train = int(learned)
    shared = spark.sparkContext.broadcast((first_id, n_train, vocabulary, int(texts)))

    class Counted:
        """A chunk with its words' ids, counts and probabilities."""

        def __init__(self, folder: Folder, name: str, payloads: dict[int, bytes] | None):
            self.c, self.name, self.folder = Chunk(folder, name), name, folder
            first_id, total, v, self.texts = shared.value
            if payloads is None:
                count, ids = (unpack(x) for x in unframe(folder.read(f"{name}.words")))
            else:
                shard = shard_of_words(self.c.code)
                parts = {s: unframe(p) for s, p in payloads.items()}
                count = replies_in_order({s: p[0] for s, p in parts.items()}, shard)
                ids = replies_in_order({s: p[1] for s, p in parts.items()}, shard)
                ids = np.where(ids > 0, ids - 1 + first_id[shard], 0)
                ids[self.c.code == START_CODE] = 1
                folder.write(f"{name}.words", frame([pack(count), pack(ids)]))
            self.count, self.ids = count, ids
            self.p1 = (count + 0.5) / (total + 0.5 * (v + 1))
            c = self.c
            self.w, self.v, self.u = ids[c.w], ids[c.v], ids[c.u]
            key = (self.v.astype(np.uint64) << np.uint64(32)) | self.w.astype(np.uint64)
            self.pairs, self.place, self.learned = distinct(key, c.learned)
            self.asked = (self.pairs >> np.uint64(32) > 0) & (self.pairs & np.uint64(0xFFFFFFFF) > 0)
            self.pair_shard = (mix64(self.pairs[self.asked]) % np.uint64(shards)).astype(np.int64)

        def with_pairs(self, payloads: dict[int, bytes] | None) -> Counted:
            """Counts of pairs; of words as contexts; P2 and c(u v)."""
            c = self.c
            if payloads is None:
                got = unpack(self.folder.read(f"{self.name}.pairs"))
            else:
                got = replies_in_order({s: unframe(p)[0] for s, p in payloads.items()}, self.pair_shard)
                self.folder.write(f"{self.name}.pairs", pack(got))
            total = np.zeros(len(self.pairs), np.int64)
            total[self.asked] = got
            pair = total[self.place]
            # A word's count as a context: all its occurrences, for none but
            # the end is the last token; the start mark's is that of texts.
            context = self.count.copy()
            context[c.code == START_CODE] = self.texts
            context = context[c.v]
            k2 = kappa(K2, context)
            p1 = self.p1[c.w]
            self.p2 = np.where(context > 0, (pair + k2 * p1) / np.maximum(context + k2, 1e-9), p1)
            # c(u v) is the count of the pair before, in the same segment.
            self.context2 = np.zeros(len(pair), np.int64)
            self.context2[1:] = pair[:-1]
            self.context2[c.first] = 0
            used = (self.context2 >= least_context) & (self.w > 0)
            self.used = np.flatnonzero(used)
            uv = self.place[self.used - 1]
            self.t_keys, self.t_place, self.t_learned = distinct(
                uv.astype(np.int64) << np.int64(32) | self.w[self.used], c.learned[self.used])
            first_at = np.zeros(len(self.t_keys), np.int64)
            first_at[self.t_place] = self.used
            self.t_at = first_at
            uv_key = self.pairs[self.t_keys >> 32]
            hot = self.context2[first_at] > shard_entries // 8
            salt = np.where(hot, mix64(self.w[first_at]) % np.uint64(1 << 16), 0).astype(np.uint64)
            self.t_shard = (mix64(mix64(uv_key) + salt) % np.uint64(shards)).astype(np.int64)
            self.t_uv = uv_key
            return self

    def grouped(batches: Iterator[pa.RecordBatch]) -> tuple[str, dict[int, bytes]]:
        got: dict[int, bytes] = {}
        name = ""
        for b in batches:
            name = b.column(0)[0].as_py()
            got.update(zip(b.column(1).to_pylist(), b.column(2).to_pylist()))
        return name, got

    def ask_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, got = grouped(batches)
        c = Counted(Folder(files), name, got)
        yield from requests(name, c.pair_shard, [c.pairs[c.asked], c.learned[c.asked]])

    write_table(replies.where("chunk <> ''").groupBy("chunk").applyInArrow(ask_pairs, _REQUEST)
                .groupBy("shard").applyInArrow(count_shard(False), _REPLY).where("chunk <> ''"), f"{home}/pairs")

    # Triples.
    def ask_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, got = grouped(batches)
        c = Counted(Folder(files), name, None).with_pairs(got)
        yield from requests(name, c.t_shard, [c.t_uv, c.w[c.t_at], c.t_learned, c.context2[c.t_at],
                                              quantise(c.p2[c.t_at]) >> P2_BITS], pack_triples)

    def trie_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, entries, sizes, number = [], [], [], 0
        for b in batches:
            number = b.column(0)[0].as_py()
            for chunk, payload in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                chunks.append(chunk)
                entries.append(unpack_triples(payload))
                sizes.append(len(entries[-1][0]))
        if not chunks:
            return
        uv, w, n, context, p2 = (np.concatenate(x) for x in zip(*entries))
        del entries
        # By (uv, w): contexts are numbered, so that one key orders both.
        head = np.ones(len(uv), bool)
        head[1:] = uv[1:] != uv[:-1]
        rank = np.unique(uv[head], return_inverse=True)[1][np.cumsum(head) - 1]
        key = rank.astype(np.int64) << np.int64(32) | w
        order = np.argsort(key, kind="stable")  # sorted runs, one a chunk
        key = key[order]
        new = np.ones(len(uv), bool)
        new[1:] = key[1:] != key[:-1]
        del head, rank, key
        uv, w, n, context, p2 = (x[order] for x in (uv, w, n, context, p2))
        asked = np.flatnonzero(new)  # the distinct entries, sorted
        total = np.add.reduceat(n, asked) if len(asked) else n
        first, total = asked[total > 0], total[total > 0]
        k3 = kappa(K3, context[first])
        lower = 10.0 ** log10_of((p2[first] << P2_BITS) + (1 << P2_BITS) // 2)
        p3 = (total + k3 * lower) / (context[first] + k3)
        backoff = k3 / (context[first] + k3)
        folder = Folder(model_dir)
        name = f"shard-{number:08d}"
        folder.write(name, Trie.build(uv[first] >> np.uint64(32), uv[first] & np.uint64(0xFFFFFFFF), w[first],
                                      quantise(backoff), quantise(p3)).to_bytes())
        trie = Trie.open(folder.view(name))
        _, found = trie.look_up(uv[asked] >> np.uint64(32), uv[asked] & np.uint64(0xFFFFFFFF), w[asked])
        code = np.empty(len(order), np.uint16)
        code[order] = found[np.cumsum(new) - 1]
        for chunk, part in zip(chunks, np.split(code, np.cumsum(sizes)[:-1])):
            yield batch([(chunk, number, pack(part))], _REPLY)

    write_table(spark.read.schema(_REPLY).parquet(f"{home}/pairs").groupBy("chunk").applyInArrow(ask_triples, _REQUEST)
                .groupBy("shard").applyInArrow(trie_shard, _REPLY), f"{home}/triples")

    # Sums.
    partial = "row long, doc_id long, null boolean, held_out boolean, n_tokens long, n_known long, base double, score double"

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, got = grouped(batches)
        x = Counted(Folder(files), name, None).with_pairs(None)
        c = x.c
        p = np.log10(x.p2)
        code = replies_in_order(got, x.t_shard)[x.t_place]
        # Contexts that count, but without this word, back off.
        in_context = x.context2 >= least_context
        k3 = kappa(K3, x.context2[in_context])
        p[in_context] += np.log10(k3 / (x.context2[in_context] + k3))
        p[x.used[code > 0]] = log10_of(code[code > 0])
        def total(values: np.ndarray) -> np.ndarray:
            return np.bincount(c.segment, values * c.counted, minlength=len(c.n))

        yield batch(list(zip(c.row.tolist(), c.doc.tolist(), c.null.tolist(), c.held.tolist(),
                             (c.n - c.repeated).tolist(), total(x.count[c.w] > 0).astype(int).tolist(),
                             total(np.log10(x.p1)[c.w]).tolist(), total(p).tolist())), partial)

    sums = (spark.read.schema(_REPLY).parquet(f"{home}/triples").groupBy("chunk").applyInArrow(add_up, partial)
            .groupBy("row", "doc_id", "null", "held_out")
            .agg(F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
                 F.sum("base").alias("base_score"), F.sum("score").alias("score")))
    return sums.select(F.when(~F.col("null"), F.col("doc_id")).alias("doc_id"), "held_out", "n_tokens", "n_known",
                       F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score")
