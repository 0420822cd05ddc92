import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import ROWS, docs_frame, empty_docs
from tokenizers import Tokenizer
from tokenloom.llm import token_frames as T
from tokenloom.llm.queries import tokenizer_path
from tokenloom.session import shared_path

PATH = tokenizer_path("byte_bpe_50k.json")
HARD = ["", " ", "  lead", "a  b   c \n d\n\n e \n", "tab\t x \t y ", "x <|endoftext|> y<|endoftext|>", "a \x1cb \x85c\xa0 d",
        "don't WE'LL 12 345 ñ̃ \u2003z", "x" * 3000 + " " + "no" * 700, "한국어 漢字 ÀÉ Ǆǅ", "1,5 .a, b. C! d?"]


def test_pieces_give_the_library_s_ids():
    tokenizer = Tokenizer.from_file(PATH)
    texts = HARD + [t or "" for _, t, _ in ROWS]
    for _ in range(2):  # the second time from memory
        for text, ids in zip(texts, T.byte_bpe(PATH).encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_that_are_not_cut_off():
    pieces = ["", "a", "\t", "~x", "\x7f", "é", "\xa0x", "\u2003", "漢", "!", "\u200bq", "\x01", "z"]
    wanted = [not p or p[0] < "!" or (p[0] > "~" and T.UNSAFE_AFTER_SPACE.match(p) is not None) for p in pieces]
    column = pa.array(pieces, pa.large_string())
    assert T.ByteBpe._unsafe(column, pieces).tolist() == wanted
    assert T.ByteBpe._unsafe(column[3:], pieces[3:]).tolist() == wanted[3:]
    assert T.ByteBpe._unsafe(column[:1], [""]).tolist() == [True]


def test_file_reads_only_what_is_asked():
    docs = [(i if i != 3 else None, np.arange(i * 7, dtype="<u4").tobytes()) for i in range(60)]
    out = io.BytesIO()
    w = T.FrameWriter(out, frame_tokens=100)
    for d in docs:
        w.add(*d)
    w.finish()
    data = out.getvalue()
    assert w.size == len(data)
    r = T.FrameReader(io.BytesIO(data), len(data))
    assert [r.document(i) for i in range(len(r))] == [d[1] for d in docs]
    assert r.nulls.tolist() == [d[0] is None for d in docs]
    fresh = T.FrameReader(io.BytesIO(data), len(data))
    assert fresh.document(20) == docs[20][1] and fresh.decompressed <= 3
    broken = bytearray(data)
    broken[30] ^= 0xFF
    with pytest.raises(Exception):
        T.FrameReader(io.BytesIO(bytes(broken)), len(data)).document(5)


def test_any_zstandard_tool_reads_the_frames():
    import zstandard
    out = io.BytesIO()
    w = T.FrameWriter(out, frame_tokens=10)
    w.add(1, np.arange(95, dtype="<u4").tobytes())
    w.finish()
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True).read()
    assert np.frombuffer(whole, "<u4").tolist() == list(range(95))


def test_round_trip(spark):
    tokenizer = Tokenizer.from_file(PATH)
    got = T.token_digests(docs_frame(spark), PATH).collect()
    assert len(got) == len(ROWS)
    rows = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted([i for i, _, _ in ROWS if i is not None]) + [None]
    at = 0
    text = {i: t or "" for i, t, _ in ROWS}
    for r in rows:
        ids = tokenizer.encode(text[r.doc_id], add_special_tokens=False).ids + [0]
        assert (r.start, r.n_tokens) == (at, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_empty_table_and_wanted(spark):
    assert T.token_digests(empty_docs(spark), PATH).count() == 0
    manifest = T.write_token_files(docs_frame(spark), shared_path(spark, "t"), PATH, frame_tokens=64, parts=3)
    some = T.read_token_files(manifest, "doc_id long, n long", lambda s, n, d, ids: (d, n), wanted={12, -4}).collect()
    assert sorted(r.doc_id for r in some) == [-4, 12]


def test_memory_of_pieces_is_bounded():
    encoder = T.ByteBpe(PATH)
    for g in range(5):
        words = [f"q{i}" for i in range(g * 100_000, (g + 1) * 100_000)]
        encoder.encode([" ".join(words[i:i + 1000]) for i in range(0, len(words), 1000)])
    assert len(encoder.first) <= len(encoder.rest) <= 400_000 and len(encoder.first.words) <= 500_000
    assert encoder.encode(["q1 q2"]) == T.ByteBpe(PATH).encode(["q1 q2"])
