import hashlib
import random

from cases import LONG, ROWS, docs_frame, empty_docs
from tokenloom.llm import fingerprints as P


def slow_ends(data):
    """The same boundaries, byte by byte."""
    out, start, h, mask = [], 0, 0, (1 << 32) - 1
    for i, b in enumerate(data):
        h = ((h << 2) + int(P._GEAR[b])) & mask
        n = i + 1 - start
        bits = P.STRICT_BITS if n < P.NORMAL_CHUNK else P.LOOSE_BITS
        if (n >= P.MIN_CHUNK and n + (len(data) - i - 1) > P.MIN_CHUNK and h >> (32 - bits) == 0) or n == P.MAX_CHUNK:
            out.append(i + 1)
            start = i + 1
    return out + [len(data)] * (start < len(data))


def test_boundaries_agree_with_a_byte_loop():
    r = random.Random(4)
    for n in (0, 1, 15, 16, 17, 300, 5000):
        data = bytes(r.randrange(97, 110) for _ in range(n))
        ends = P.chunk_ends(data)
        assert ends == sorted(set(ends)) and (ends or [0])[-1] == n
        sizes = [b - a for a, b in zip([0, *ends], ends)]
        assert all(P.MIN_CHUNK <= s <= P.MAX_CHUNK for s in sizes[:-1])
        assert ends[:-2] == slow_ends(data)[:len(ends) - 2]
    assert P.chunk_ends(b"a" * 1000)[0] in (P.MIN_CHUNK, P.NORMAL_CHUNK, P.MAX_CHUNK)


def test_tiles_don_t_show(monkeypatch):
    data = LONG.encode()[:50_000]
    whole = P.chunk_ends(data)
    monkeypatch.setattr(P, "_TILE", 1000)
    assert P.chunk_ends(data) == whole


def test_shift_resistance_and_containment():
    a = P.chunk_set(LONG[:20_000].encode())
    b = P.chunk_set(("a few words before " + LONG[:20_000]).encode())
    assert P.containment(a, b) > 0.95
    assert P.from_string(P.to_string(a)) == a
    assert P.containment({}, {}) == 1.0 and P.containment({}, a) == 0.0 and P.containment(a, {}) == 0.0


def test_neighbours_against_brute_force(spark):
    rows = [r for r in ROWS if r[0] is not None]
    order = sorted({(i, t or "") for i, t, _ in rows}, key=lambda r: -r[0])
    for parts in (2, 5):
        got = P.compare_neighbours(docs_frame(spark), parts).collect()
        assert len(got) == len(ROWS)
        found = {(r.doc_id, r.n_chars): r for r in got}
        for at, (i, t) in enumerate(order):
            if i == 3 or order[(at + 1) % len(order)][0] == 3 or at == len(order) - 1:
                continue  # repeated rows follow themselves; the null id is last
            nxt = order[at + 1][1]
            edited = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
            r = found[(i, len(t))]
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert r.fingerprint == P.to_string(P.chunk_set(t.encode()))
            assert r.edited_fingerprint == P.to_string(P.chunk_set(edited.encode()))
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        last = found[(None, len("a lone text without an id"))]
        first = order[0][1]
        t = "a lone text without an id"
        assert last.edited_sha256 == hashlib.sha256((t[:len(t) - len(t) // 2] + first[:len(t) // 2]).encode()).hexdigest()


def test_empty_and_single(spark):
    assert P.compare_neighbours(empty_docs(spark)).count() == 0
    one = P.compare_neighbours(docs_frame(spark, [(1, "alone in the table, long enough to be cut in chunks", 1)])).first()
    assert one.near_next == 1.0
    assert P.fingerprint_documents(docs_frame(spark)).where("fingerprint = ''").count() == 2
