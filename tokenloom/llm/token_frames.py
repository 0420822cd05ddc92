"""Token ids in binary files of independent zstandard frames.

File format: data frames (each an independent zstandard frame with its own
content checksum, holding ``frame_tokens`` little-endian unsigned 32-bit ids
at most), a skippable frame with the document index, and the seek table of
the public seekable zstandard format as the last skippable frame: per frame
its compressed size, decompressed size and the low 32 bits of the xxh64 of
its content; then the number of frames, a descriptor and a magic number.

The document index holds, zstandard-compressed: doc ids (int64), null flags
(uint8) and end positions in ids (int64); then its frame's size and a mark.

A reader gets the seek table and the index from the file's end and then reads
and decompresses the frames that hold the documents it wants.

Cases: a null text counts as empty and has the end id alone; null ids come
last; ties of doc_id are ordered by the text's digest; an empty table gives
no file and no rows.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from .common import batched, id_runs, text_or_empty
from .memo import UNSAFE_AFTER_SPACE, PieceMemo, byte_level_words, load_tokenizer, safe_pieces

# Fixed values of the zstandard and the seekable format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

INDEX_MARK = b"docindex"
FRAME_TOKENS = 1 << 16
END_ID = 0
LEVEL = 3
REMEMBERED = 400_000  # pieces, and words, whose ids a Python worker keeps; about 0.1 GB


class FrameWriter:
    """Write documents' ids to a binary stream in the format above."""

    def __init__(self, out, frame_tokens: int = FRAME_TOKENS, level: int = LEVEL):
        self.out, self.frame_bytes = out, 4 * frame_tokens
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.held, self.frames = bytearray(), []
        self.ids, self.nulls, self.ends, self.total, self.size = array("q"), bytearray(), array("q"), 0, 0

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def _frame(self, content: bytes) -> None:
        packed = self.packer.compress(content)
        self.frames.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self._put(packed)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids``: little-endian unsigned 32-bit."""
        self.held += ids
        self.total += len(ids) // 4
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.ends.append(self.total)
        n = self.frame_bytes
        full = len(self.held) // n * n
        for i in range(0, full, n):
            self._frame(bytes(self.held[i:i + n]))
        del self.held[:full]

    def finish(self) -> None:
        if self.held:
            self._frame(bytes(self.held))
        raw = np.array(self.ids, "<i8").tobytes() + bytes(self.nulls) + np.array(self.ends, "<i8").tobytes()
        index = struct.pack("<Q", len(self.ids)) + self.packer.compress(raw)
        size = 8 + len(index) + 16
        self._put(struct.pack("<II", SKIPPABLE_INDEX, size - 8) + index + struct.pack("<Q", size) + INDEX_MARK)
        table = b"".join([struct.pack("<III", *f) for f in self.frames])
        self._put(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table) + 9) + table
                  + struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC))


class FrameReader:
    """Random access to the documents of a file (a seekable binary stream)."""

    def __init__(self, source, size: int):
        self.source, self.unpacker = source, zstandard.ZstdDecompressor()
        n, flags, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        table_at = size - 9 - 12 * n - 8
        entries = list(struct.iter_unpack("<III", self._read(table_at + 8, 12 * n)))
        self.frames, at, start = [], 0, 0
        for packed, length, check in entries:
            self.frames.append((at, packed, start, length, check))
            at, start = at + packed, start + length
        index_size, mark = struct.unpack("<Q8s", self._read(table_at - 16, 16))
        if mark != INDEX_MARK:
            raise ValueError("no document index before the seek table")
        index = self._read(table_at - index_size + 8, index_size - 24)
        docs = struct.unpack("<Q", index[:8])[0]
        raw = self.unpacker.decompress(index[8:])
        self.doc_ids = np.frombuffer(raw, "<i8", docs)
        self.nulls = np.frombuffer(raw, np.uint8, docs, 8 * docs).astype(bool)
        self.ends = np.frombuffer(raw, "<i8", docs, 9 * docs)
        self.starts = [f[2] for f in self.frames]
        self._last = (-1, b"")
        self.decompressed = 0

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def __len__(self) -> int:
        return len(self.ends)

    def frame(self, k: int) -> bytes:
        """Content of a frame, checked against the seek table."""
        if self._last[0] != k:
            at, packed, _, length, check = self.frames[k]
            content = self.unpacker.decompress(self._read(at, packed), max_output_size=length)
            if len(content) != length or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {k} doesn't agree with its checksum")
            self._last = (k, content)
            self.decompressed += 1
        return self._last[1]

    def document(self, i: int) -> bytes:
        """Ids of the i-th document, from the frames that hold it."""
        start, end = 4 * (int(self.ends[i - 1]) if i else 0), 4 * int(self.ends[i])
        parts = []
        k = bisect_right(self.starts, start) - 1
        while start < end:
            content, base = self.frame(k), self.frames[k][2]
            parts.append(content[start - base:end - base])
            start = base + len(content)
            k += 1
        return b"".join(parts)


def open_file(path: str):
    """A reader for a file in any store that pyarrow can open."""
    fs, inner = pafs.FileSystem.from_uri(path)
    source = fs.open_input_file(inner)
    return FrameReader(source, source.size())


_PACKED = [struct.Struct(f"<{n}I") for n in range(64)]


def _id_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit."""
    return _PACKED[len(ids)].pack(*ids) if len(ids) < len(_PACKED) else np.array(ids, "<u4").tobytes()


class ByteBpe:
    """Ids of a byte-level vocabulary, as the library gives for whole texts.

    Texts are split at spaces, and equal pieces are found, by Arrow; only the
    distinct pieces of a batch are looked at in Python. Their ids lie in one
    column, from which Arrow gathers those of all texts. Texts with a piece that
    may not be cut off (white space runs) are put together piece by piece.
    """

    def __init__(self, path: str):
        tokenizer = load_tokenizer(path)
        how = (tokenizer, byte_level_words, _id_bytes, b"".join)
        self.first = PieceMemo(*how, limit=REMEMBERED)
        self.rest = PieceMemo(*how, prefix=" ", limit=REMEMBERED, words=self.first.words)

    def encode(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        pieces = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        at = pieces.offsets.to_numpy().astype(np.int64)
        coded = pieces.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        distinct = coded.dictionary.to_pylist()
        unsafe = self._unsafe(coded.dictionary, distinct)
        bad = unsafe[codes]
        bad[at[:-1]] = False  # no space before a first piece
        whole = np.add.reduceat(bad, at[:-1]) == 0
        out: list[bytes] = [b""] * len(texts)
        odd = np.flatnonzero(~whole).tolist()
        for i, ids in zip(odd, self._by_pieces([texts[i] for i in odd])):
            out[i] = ids

        # Firsts are entries of their own behind the distinct pieces.
        firsts = [distinct[k] for k in codes[at[:-1]].tolist()]
        self.first.learn([p for p, fine in zip(firsts, whole.tolist()) if fine])
        used = np.zeros(len(distinct), bool)
        kept = np.repeat(whole, np.diff(at))
        inner = kept.copy()
        inner[at[:-1]] = False
        used[codes[inner]] = True
        needed = list(compress(distinct, used.tolist()))
        self.rest.learn(needed)
        entries = list(map(self.rest.__getitem__, needed))
        entries += [self.first[p] if fine else b"" for p, fine in zip(firsts, whole.tolist())]
        place = np.cumsum(used, dtype=np.int32) - np.int32(1)
        where = place[codes]
        where[at[:-1]] = np.arange(len(needed), len(entries))
        upto = at if whole.all() else np.concatenate([[0], np.cumsum(kept)])[at]
        gathered = pa.array(entries, pa.large_binary()).take(pa.array(where if upto is at else where[kept]))
        ends = np.frombuffer(gathered.buffers()[1], np.int64, len(gathered) + 1)[upto].tolist()
        data = memoryview(gathered.buffers()[2] or b"")
        for i in np.flatnonzero(whole).tolist():
            out[i] = data[ends[i]:ends[i + 1]].tobytes()
        return out

    @staticmethod
    def _unsafe(column: pa.Array, pieces: list[str]) -> np.ndarray:
        """Which of the pieces may not be cut off at the space before them;
        most begin with a printable ASCII character and are safe."""
        starts = np.frombuffer(column.buffers()[1], np.int64, len(pieces) + 1, 8 * column.offset)
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        head = np.append(data, np.uint8(0))[np.minimum(starts[:-1], len(data))]
        unsafe = (starts[1:] == starts[:-1]) | (head < ord("!"))
        for i in np.flatnonzero(~unsafe & (head > ord("~"))).tolist():
            p = pieces[i]
            unsafe[i] = p[0] < "!" or (p[0] > "~" and UNSAFE_AFTER_SPACE.match(p) is not None)
        return unsafe

    def _by_pieces(self, texts: list[str]) -> list[bytes]:
        cut = [safe_pieces(t) for t in texts]
        self.first.learn([c[0] for c in cut])
        rest: set[str] = set()
        for c in cut:
            rest.update(c[1:])
        self.rest.learn(rest)
        get = self.rest.__getitem__
        return [self.first[c[0]] + b"".join(map(get, c[1:])) for c in cut]


_ENCODERS: dict[str, ByteBpe] = {}


def byte_bpe(path: str) -> ByteBpe:
    """One encoder a Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteBpe(path)
    return _ENCODERS[path]


MANIFEST = "run int, path string, n_docs long, n_tokens long, n_bytes long"


def write_token_files(docs: DataFrame, target: str, tokenizer_path: str, end_id: int = END_ID,
                      frame_tokens: int = FRAME_TOKENS, parts: int | None = None) -> DataFrame:
    """Encode ``docs`` and write one file for each range of doc_id below
    ``target``. Returns the manifest (also written there); files that it does
    not name come from lost attempts and are ignored. A run streams through
    its task: texts are encoded a few MB at a time."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    runs = id_runs(rows, parts=parts)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(tokenizer_path)
        end = struct.pack("<I", end_id)
        fs, inner = pafs.FileSystem.from_uri(target)

        def rows_in():
            for b in batches:
                yield from zip(*[c.to_pylist() for c in b.columns])

        done, state = [], None

        def close():
            if state:
                state[3].finish()
                state[2].close()
                w = state[3]
                done.append((state[0], f"{target}/{state[1]}", len(w.ends), w.total, w.size))

        for group in batched(rows_in(), lambda r: len(r[2]), 4 << 20):
            for (run, doc_id, _), ids in zip(group, encoder.encode([r[2] for r in group])):
                if state is None or state[0] != run:
                    close()
                    name = f"run-{run:06d}-{uuid.uuid4().hex[:12]}.tokz"
                    fs.create_dir(inner, recursive=True)
                    out = fs.open_output_stream(f"{inner}/{name}")
                    state = (run, name, out, FrameWriter(out, frame_tokens))
                state[3].add(doc_id, ids + end)
        close()
        pa.default_memory_pool().release_unused()  # the worker stays, for other work too
        if done:
            types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)],
                                             names=["run", "path", "n_docs", "n_tokens", "n_bytes"])

    ordered = (runs.column(rows, "doc_id").withColumn("tie", F.xxhash64("text"))
               .repartitionById(runs.count, F.col("run"))
               .sortWithinPartitions("run", F.asc_nulls_last("doc_id"), "tie", "text")
               .select("run", "doc_id", "text"))
    ordered.mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(f"{target}/manifest")
    return docs.sparkSession.read.parquet(f"{target}/manifest")


def read_token_files(manifest: DataFrame, schema: str, rows_of: Callable[[int, int, int | None, bytes], tuple],
                     wanted: set[int] | None = None) -> DataFrame:
    """One row per document from the files: ``rows_of(start, n_tokens, doc_id,
    ids)``. ``wanted``: read those documents alone (a small set)."""
    spark = manifest.sparkSession
    files, base = [], 0
    for r in sorted(manifest.collect(), key=lambda r: r["run"]):  # one row a file
        files.append((r["path"], base))
        base += r["n_tokens"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                for path, base in zip(*[c.to_pylist() for c in b.columns]):
                    f = open_file(path)
                    starts = np.concatenate([[0], f.ends[:-1]]).tolist() if len(f) else []
                    for i, (start, end) in enumerate(zip(starts, f.ends.tolist())):
                        doc_id = None if f.nulls[i] else int(f.doc_ids[i])
                        if wanted is None or doc_id in wanted:
                            yield rows_of(base + start, end - start, doc_id, f.document(i))

        out = pa.schema(target)
        for group in batched(rows(), lambda r: 100, 1 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*group), out)], schema=out)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))
    listed = spark.createDataFrame(files, "path string, base long")
    return listed.repartition(max(1, len(files))).mapInArrow(read, schema)


def token_digests(docs: DataFrame, tokenizer_path: str, target: str | None = None) -> DataFrame:
    """Write ``docs`` and read the files back: (doc_id, start, n_tokens,
    ids_crc32)."""
    manifest = write_token_files(docs, target or shared_path(docs.sparkSession, "token-files"), tokenizer_path)
    return read_token_files(manifest, "doc_id long, start long, n_tokens long, ids_crc32 long",
                            lambda start, n, doc_id, ids: (doc_id, start, n, zlib.crc32(ids)))
