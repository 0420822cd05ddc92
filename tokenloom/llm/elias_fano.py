"""Elias-Fano coded sequences and an n-gram trie whose levels are such
sequences, all with numpy and readable from memory-mapped bytes."""

from __future__ import annotations

import json

import numpy as np

#: Place of the k-th set bit of a byte.
_SELECT = np.zeros((256, 8), np.uint8)
for _b in range(256):
    for _k, _i in enumerate([i for i in range(8) if _b >> i & 1]):
        _SELECT[_b, _k] = _i
_ONES, _HIGH = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_STEP = 1 << 15  # places that are looked up at a time


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """``width`` low bits of each value, one after the other, in whole words of
    64 bits and one more. 64 values fill ``width`` words."""
    n = len(values) if width else 0
    words = np.zeros((-(-n // 64), width), np.uint64)
    rows = np.zeros((len(words), 64), np.uint64)
    if n:
        rows.ravel()[:n] = np.asarray(values, np.uint64) & np.uint64((1 << width) - 1)
    columns = np.ascontiguousarray(rows.T)
    for j in range(64 if n else 0):
        word, shift = divmod(j * width, 64)
        words[:, word] |= columns[j] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= columns[j] >> np.uint64(64 - shift)
    return np.append(words.ravel()[:-(-n * width // 64)], np.uint64(0)).view(np.uint8)


def unpack_bits(data: np.ndarray, index: np.ndarray, width: int) -> np.ndarray:
    """The values of ``pack_bits`` at the places ``index`` (width <= 56)."""
    if not width:
        return np.zeros(len(index), np.uint64)
    words = data.view(np.uint64)
    bit = index.astype(np.int64) * width
    at, shift = bit >> 6, (bit & 63).astype(np.uint64)
    # A shift by 64 isn't defined; by 1 and then 63 it is.
    out = words[at] >> shift | words[at + 1] << np.uint64(1) << (np.uint64(63) - shift)
    return out & np.uint64((1 << width) - 1)


def select_bit(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th set bit (from 0) of each word of 64 bits."""
    count = words - (words >> np.uint64(1) & np.uint64(0x5555555555555555))
    count = ((count & np.uint64(0x3333333333333333))
             + (count >> np.uint64(2) & np.uint64(0x3333333333333333)))
    upto = (count + (count >> np.uint64(4)) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _ONES  # bits up to each byte's end
    before = ((k * _ONES | _HIGH) - upto & _HIGH) >> np.uint64(7)  # bytes that end before the bit
    shift = (before * _ONES >> np.uint64(56)) << np.uint64(3)
    left = k - (upto << np.uint64(8) >> shift & np.uint64(255))
    return shift + _SELECT[words >> shift & np.uint64(255), left]


class EliasFano:
    """A monotone sequence of non-negative integers: low bits packed, high
    bits as a unary bit string with a directory of its bytes' ranks."""

    def __init__(self, parts: dict[str, np.ndarray], n: int, low_bits: int):
        self.parts, self.n, self.low_bits = parts, n, low_bits

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        low_bits = min(56, max(0, (top // max(1, n)).bit_length() - 1))
        high = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros((int(high[-1]) if n else 0) + 1, np.uint8)
        flags[high] = 1
        bits = np.packbits(np.append(flags, np.zeros(-len(flags) % 64, np.uint8)), bitorder="little")
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(bits.view(np.uint64)), dtype=np.int64)])
        return cls({"low": pack_bits(values, low_bits), "high": bits, "ranks": ranks.astype(np.uint32)}, n, low_bits)

    def at(self, index: np.ndarray) -> np.ndarray:
        """Values at those places."""
        index = np.asarray(index, np.int64)
        if len(index) > _STEP:
            return np.concatenate([self.at(index[i:i + _STEP]) for i in range(0, len(index), _STEP)])
        words, ranks = self.parts["high"].view(np.uint64), self.parts["ranks"]
        # As unsigned 32-bit numbers, or all ranks would be converted.
        block = np.searchsorted(ranks, index.astype(np.uint32), side="right") - 1
        left = (index - ranks[block]).astype(np.uint64)
        place = (block << 6) + select_bit(words[block], left).astype(np.int64)
        high = (place - index).astype(np.uint64) << np.uint64(self.low_bits)
        return high | unpack_bits(self.parts["low"], index, self.low_bits)

    def successor(self, target: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Place of the first value >= target in [start, end); else end."""
        low, high = np.asarray(start, np.int64).copy(), np.asarray(end, np.int64).copy()
        target = np.asarray(target, np.uint64)
        todo = np.flatnonzero(low < high)
        while len(todo):
            mid = (low[todo] + high[todo]) >> 1
            less = self.at(mid) < target[todo]
            low[todo[less]] = mid[less] + 1
            high[todo[~less]] = mid[~less]
            todo = todo[low[todo] < high[todo]]
        return low


class Trie:
    """Three levels: words, their successors, and the successors of pairs.

    ``words`` is a monotone sequence. The successors of a node are a range of
    the next level, found by the monotone ``pointers``; to make a level
    monotone, each range's values are raised by the last value of the range
    before it, so a search in a range is a search for a successor relative to
    its context. Pairs hold the quantised back-off weight of the context that
    they are, triples their quantised smoothed probability.
    """

    SEQUENCES = ("words", "pointers1", "pairs", "pointers2", "triples")
    ARRAYS = ("backoffs", "probabilities")

    def __init__(self, sequences: dict[str, EliasFano], arrays: dict[str, np.ndarray]):
        self.s, self.a = sequences, arrays

    @staticmethod
    def _raised(values: np.ndarray, new_range: np.ndarray) -> np.ndarray:
        """Values of ranges, made monotone over all ranges."""
        if not len(values):
            return values
        last = np.flatnonzero(np.append(new_range[1:], True))
        base = np.concatenate([[0], np.cumsum(values[last] + 1)[:-1]])
        return values + base[np.cumsum(new_range) - 1]

    @classmethod
    def build(cls, u, v, w, backoff, probability) -> Trie:
        """From distinct triples sorted by (u, v, w): ``backoff`` belongs to
        (u, v), ``probability`` to the triple; both are codes."""
        u, v, w = (np.asarray(x, np.int64) for x in (u, v, w))
        n = len(u)
        new1 = np.ones(n, bool)
        new1[1:] = u[1:] != u[:-1]
        new2 = new1.copy()
        new2[1:] |= v[1:] != v[:-1]
        first2 = np.flatnonzero(new2)
        first1 = np.flatnonzero(new1[first2])
        code = EliasFano.encode
        return cls({"words": code(u[first2][first1]),
                    "pointers1": code(np.append(first1, len(first2))),
                    "pairs": code(cls._raised(v[first2], new1[first2])),
                    "pointers2": code(np.append(first2, n)),
                    "triples": code(cls._raised(w, new2))},
                   {"backoffs": np.asarray(backoff, np.uint16)[first2],
                    "probabilities": np.asarray(probability, np.uint16)})

    def _child(self, level: str, start, end, value, run=None) -> np.ndarray:
        """Place of ``value`` in the range, or -1; ``run``: which of the ranges
        is each value's, if there are fewer ranges."""
        seq = self.s[level]
        base = np.zeros(len(start), np.uint64)
        after = start > 0
        if after.any():
            base[after] = seq.at(start[after] - 1) + np.uint64(1)
        if run is not None:
            base, start, end = base[run], start[run], end[run]
        target = base + value.astype(np.uint64)
        at = seq.successor(target, start, end)
        found = at < end
        found[found] = seq.at(at[found]) == target[found]
        return np.where(found, at, -1)

    def pair(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Node of each context (u, v), or -1."""
        u, v = np.asarray(u, np.int64), np.asarray(v, np.int64)
        words = self.s["words"]
        distinct, place = np.unique(u, return_inverse=True)
        at = words.successor(distinct.astype(np.uint64), np.zeros(len(distinct), np.int64),
                             np.full(len(distinct), words.n))
        known = at < words.n
        known[known] = words.at(at[known]) == distinct[known].astype(np.uint64)
        at, known = at[place], known[place]
        out = np.full(len(u), -1, np.int64)
        if known.any():
            p = self.s["pointers1"]
            start, end = p.at(at[known]).astype(np.int64), p.at(at[known] + 1).astype(np.int64)
            out[known] = self._child("pairs", start, end, v[known])
        return out

    def look_up(self, u, v, w) -> tuple[np.ndarray, np.ndarray]:
        """(back-off code of the context, probability code of the triple); 0
        stands for an unknown one."""
        u, v = np.asarray(u, np.int64), np.asarray(v, np.int64)
        # Each run of equal contexts is searched for once.
        new = np.ones(len(u), bool)
        new[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
        node, run = self.pair(u[new], v[new]), np.cumsum(new) - 1
        backoff, found = np.zeros(len(u), np.uint16), np.zeros(len(u), np.uint16)
        known = (node >= 0)[run]
        if known.any():
            w, run = np.asarray(w, np.int64)[known], (np.cumsum(node >= 0) - 1)[run[known]]
            node = node[node >= 0]
            backoff[known] = self.a["backoffs"][node][run]
            p = self.s["pointers2"]
            start, end = p.at(node).astype(np.int64), p.at(node + 1).astype(np.int64)
            at = self._child("triples", start, end, w, run)
            hit = np.zeros(len(at), np.uint16)
            hit[at >= 0] = self.a["probabilities"][at[at >= 0]]
            found[known] = hit
        return backoff, found

    def to_bytes(self) -> bytes:
        head, blobs, at = {}, [], 0
        for name in self.SEQUENCES:
            s = self.s[name]
            head[name] = {"n": s.n, "low_bits": s.low_bits, "parts": {}}
            for part, array in s.parts.items():
                head[name]["parts"][part] = [str(array.dtype), at, len(array)]
                blobs.append(array.tobytes() + bytes(-array.nbytes % 8))
                at += len(blobs[-1])
        for name in self.ARRAYS:
            head[name] = [str(self.a[name].dtype), at, len(self.a[name])]
            blobs.append(self.a[name].tobytes() + bytes(-self.a[name].nbytes % 8))
            at += len(blobs[-1])
        text = json.dumps(head).encode()
        text += b" " * (-len(text) % 8)
        return len(text).to_bytes(8, "little") + text + b"".join(blobs)

    @classmethod
    def open(cls, data) -> Trie:
        """Over any buffer, a memory-mapped file's too; nothing is copied."""
        view = memoryview(data)
        size = int.from_bytes(view[:8], "little")
        head = json.loads(bytes(view[8:8 + size]))
        base = 8 + size

        def array(kind, at, n):
            return np.frombuffer(view, kind, n, base + at)

        return cls({k: EliasFano({p: array(*x) for p, x in head[k]["parts"].items()}, head[k]["n"], head[k]["low_bits"])
                    for k in cls.SEQUENCES}, {k: array(*head[k]) for k in cls.ARRAYS})
