import collections
import math
import time
import zlib

import numpy as np
import pytest
from cases import ROWS, docs_frame, empty_docs
from tokenloom.llm import elias_fano as E, lm_scoring as L, queries as Q


def test_elias_fano():
    r = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 5), (1000, 3000), (5000, 10**12), (3000, 10)):
        v = np.sort(r.integers(0, top, n)).astype(np.uint64)
        e = E.EliasFano.encode(v)
        assert (e.at(np.arange(n)) == v).all()
        t = r.integers(0, top + 5, 200).astype(np.uint64)
        assert (e.successor(t, np.zeros(200, int), np.full(200, n)) == np.searchsorted(v, t)).all()
    dense = E.EliasFano.encode(np.arange(100_000, dtype=np.uint64) * 1000)
    assert sum(p.nbytes for p in dense.parts.values()) < 100_000 * 14 / 8


def test_trie(tmp_path):
    r = np.random.default_rng(2)
    k = np.unique(r.integers(0, [40, 60, 90], (5000, 3)), axis=0)
    code, backoff = r.integers(1, 65535, len(k)), k[:, 0] * 100 + k[:, 1]
    (tmp_path / "t").write_bytes(E.Trie.build(*k.T, backoff, code).to_bytes())
    trie = E.Trie.open(np.memmap(tmp_path / "t", np.uint8, "r"))
    q = np.concatenate([k, r.integers(0, 100, (5000, 3))])
    b, p = trie.look_up(*q.T)
    known, contexts = dict(zip(map(tuple, k.tolist()), code.tolist())), {tuple(x[:2]) for x in k.tolist()}
    assert [known.get(tuple(x), 0) for x in q.tolist()] == p.tolist()
    assert [x[0] * 100 + x[1] if tuple(x[:2]) in contexts else 0 for x in q.tolist()] == b.tolist()
    none = E.Trie.open(E.Trie.build(*np.zeros((3, 0), int), [], []).to_bytes())
    assert none.look_up([1], [2], [3])[1].tolist() == [0]


def test_packed_bits():
    r = np.random.default_rng(3)
    for width in (0, 1, 7, 8, 21, 33, 56):
        for n in (0, 1, 63, 64, 65, 300):
            v = r.integers(0, 1 << 62, n).astype(np.uint64)
            got = E.unpack_bits(E.pack_bits(v, width), np.arange(n), width)
            assert (got == v & np.uint64((1 << width) - 1)).all()
    words = np.append(r.integers(0, 1 << 63, 200).astype(np.uint64) * np.uint64(2), np.uint64(2**64 - 1))
    for k in range(64):
        some = words[np.bitwise_count(words) > k]
        places = [[i for i in range(64) if x >> i & 1][k] for x in some.tolist()]
        assert E.select_bit(some, np.full(len(some), k, np.uint64)).tolist() == places


def test_shuffle_files_go(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        found = disk.getAllFiles()
        names = [found.apply(i).getName() for i in range(found.size())]
        return {n.split("_")[1] for n in names if n.startswith("shuffle_")}

    before = shuffled()
    rows = docs_frame(spark, [(i, f"a{i % 7} b{i % 5} c", 1) for i in range(40)])
    L.learn_and_score(rows, chunk_tokens=64, shard_entries=32)  # its steps are written, its sums aren't made
    for _ in range(50):
        left = shuffled() - before
        if len(left) <= 1:
            break
        time.sleep(0.2)
    assert len(left) <= 1  # the sums of the manifest, one row a task


def test_packed_arrays():
    for a, delta in ((np.array([], np.int64), False), (np.array([3, 5, 900]), True), (np.array([-1, 7]), False),
                     (np.array([1, 2**40]), False)):
        assert (L.unpack(L.pack(a, delta)) == a).all()


def model(rows, least=2):
    toks = [((i, t), (t or "").encode().lower().split() + ["</s>"]) for i, t, _ in rows]
    train = [w for (i, _), w in toks if i is None or zlib.crc32(str(i).encode()) % 5 != 1]
    c = collections.Counter(x for w in train for x in w)
    n, v = sum(c.values()), len(c)
    pair, triple, context = collections.Counter(), collections.Counter(), collections.Counter()
    for w in train:
        s = ["<s>", "<s>"] + w
        pair.update(zip(s[1:], s[2:]))
        context.update(s[1:-1])
        triple.update(zip(s, s[1:], s[2:]))

    def p(u, x, y):
        p1 = (c[y] + 0.5) / (n + 0.5 * (v + 1))
        k2 = L.K2 * context[x] ** L.POWER
        p2 = (pair[x, y] + k2 * p1) / (context[x] + k2) if context[x] else p1
        cu = pair[u, x]
        k3 = L.K3 * cu ** L.POWER
        return p1, (triple[u, x, y] + k3 * p2) / (cu + k3) if cu >= least else p2

    out = []
    for (i, _), w in toks:
        s = ["<s>", "<s>"] + w
        ps = [p(*z) for z in zip(s, s[1:], s[2:])]
        out.append((i, i is not None and zlib.crc32(str(i).encode()) % 5 == 1, len(w), sum(c[x] > 0 for x in w), n,
                    sum(math.log10(a) for a, _ in ps), sum(math.log10(b) for _, b in ps)))
    return out, p, c


@pytest.mark.parametrize("sizes", [(L.CHUNK_TOKENS, L.SHARD_ENTRIES), (5000, 4000)])
def test_against_a_plain_model(spark, sizes):
    rows = ROWS + [(100 + i, " ".join(["the same start of all"] * 3 + [f"w{i}"]), 1) for i in range(30)]
    got = L.learn_and_score(docs_frame(spark, rows), chunk_tokens=sizes[0], shard_entries=sizes[1]).collect()
    key = lambda r: (str(r[0]), r[2])
    want = sorted(model(rows)[0], key=key)
    for g, w in zip(sorted(map(tuple, got), key=key), want, strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], abs=1e-6)
        assert g[6] == pytest.approx(w[6], abs=1e-3 * w[2])


def test_query_uses_contexts_seen_once(spark, tmp_path):
    rows = [(i, " ".join(f"w{(7 * i + k * k) % 50}" for k in range(30)), 1) for i in range(40)]
    docs_frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = Q.op3_lm_scores(spark, str(tmp_path)).collect()
    want = {r[0]: r for r in model(rows, least=1)[0]}
    cut = {r[0]: r for r in model(rows)[0]}
    assert len(got) == len(rows) and any(abs(want[i][6] - cut[i][6]) > 0.1 for i in want)
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id][6], abs=1e-3 * want[r.doc_id][2])


def test_probabilities_add_up():
    rows = [(i, "a b c a b d a b c", 1) for i in range(9)]
    _, p, c = model(rows)
    for context in (("a", "b"), ("<s>", "a"), ("x", "y"), ("b", "c")):
        u, x = (s.encode() if len(s) == 1 else s for s in context)
        assert sum(p(u, x, y)[1] for y in [*c, "unknown"]) == pytest.approx(1)


def test_empty(spark):
    assert L.learn_and_score(empty_docs(spark)).count() == 0
