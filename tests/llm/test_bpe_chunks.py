import gc
import hashlib
import random

import pyarrow as pa
from cases import LONG, ROWS, docs_frame, empty_docs
from tokenizers import Tokenizer
from tokenloom.llm import bpe_chunks as B
from tokenloom.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
HARD = ["", "  ", " a", "a ", "it's  <|endoftext|> x y<|startoftext|>z", "Ǆ ǅx́ ́y  ÀÉ\n\t q" + "é" * 500
        + " 한국어漢字" * 300, "Σας ΣΑΣ ﬁ İI", "x" * 3000 + " " + "no" * 700, "don't WE'LL'S 12345 ñ̃   z\u2003\xa0y"]


def check(texts, encoder):
    tokenizer = Tokenizer.from_file(PATH)
    for text, got in zip(texts, encoder.encode(texts)):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert got == (len(ids), " ".join(map(str, ids)), tokenizer.decode(ids, skip_special_tokens=False))


def test_exact_agreement():
    encoder = B.ChunkEncoder(PATH)
    check(HARD + [t or "" for _, t, _ in ROWS], encoder)
    check([LONG[7:], LONG[:-9], "shared " + LONG], encoder)
    assert encoder.reused > 0.5 * encoder.seen / 3


def test_forgetting_changes_nothing():
    r = random.Random(5)
    texts = ["".join(r.choice("ab ,é\n'sZ9") for _ in range(r.randrange(3000))) for _ in range(40)]
    encoder = B.ChunkEncoder(PATH, chunk_limit=3)
    encoder.words.limit = 20
    for i in range(0, 40, 5):
        check(texts[i:i + 5], encoder)
    check(texts[:10], encoder)


def test_parts_are_left_alone_by_the_collector():
    encoder = B.ChunkEncoder(PATH)
    check([LONG], encoder)
    gc.collect()
    assert len(encoder.words) > 500 and not any(map(gc.is_tracked, encoder.words.values()))


def test_a_task_leaves_nothing_in_its_worker(spark):
    docs = docs_frame(spark).coalesce(1)
    B.encoding_digests(docs, PATH).collect()

    def held(batches):
        for _ in batches:
            found = B._ENCODERS.get(PATH)
            yield pa.RecordBatch.from_pydict({"n": [len(found.words) + len(found.chunks) if found else 0]})

    assert sum(r.n for r in docs.mapInArrow(held, "n long").collect()) == 0
    cut = list(B.slices(pa.RecordBatch.from_pydict({"t": ["ab", "", "c", "d" * 9, "e", ""]}), 4))
    assert [b.column(0).to_pylist() for b in cut] == [["ab", "", "c"], ["d" * 9], ["e", ""]]


def test_frame(spark):
    tokenizer = Tokenizer.from_file(PATH)
    docs = docs_frame(spark).withColumnRenamed("score", "N_Tokens")
    got = B.encode_documents(docs, PATH).collect()
    assert len(got) == len(ROWS)
    text = {(i, k): t or "" for i, t, k in ROWS}
    for r in got:
        ids = tokenizer.encode(text[(r.doc_id, r.run)], add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert B.encoding_digests(empty_docs(spark), PATH).count() == 0
    assert {r.decoded for r in B.decode_documents(docs.where("doc_id in (21, 22)"), PATH).collect()} == {"one</w>"}
