"""Links within crowds: nodes of long inverted lists, compared in blocks.

The pairs of a long list would be rows by the square of its members. Instead
its nodes are dealt to blocks of bounded size, kept as files in the shared
folder with each node's lists and full set, and two blocks at a time are
compared by arrays. Every pair that may be linked is decided on its full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .lm_scoring import Folder, frame, pack, unframe, unpack

#: Values of the nodes of a block, about; a node counts as some values more.
BLOCK_VALUES = 1 << 20
NODE_VALUES = 512


def starts(sizes: np.ndarray) -> np.ndarray:
    """Where each of consecutive parts begins, and the end."""
    return np.concatenate([[0], np.cumsum(sizes)])


def ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of ranges, one range after the other."""
    at = starts(sizes)
    return np.repeat(first - at[:-1], sizes) + np.arange(at[-1])


def places_in(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value in the sorted distinct values; -1 without."""
    at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
    return np.where(values[at] == wanted, at, -1)


class Block:
    """Nodes with their lists and sets; keys and values are numbered."""

    def __init__(self, data: bytes):
        parts = unframe(data)
        self.node, self.root, self.n, self.keys, self.values, degree = map(unpack, parts[:6])
        self.key, self.place, self.value = (unpack(p, np.int32) for p in parts[6:])
        self.key_at, self.at = starts(degree), starts(self.n)
        order = np.argsort(self.key, kind="stable")
        self.list_owner = np.repeat(np.arange(len(degree)), degree)[order]
        self.list_place = self.place[order]
        self.list_at = np.searchsorted(self.key[order], np.arange(len(self.keys) + 1))

    @staticmethod
    def packed(node: np.ndarray, root: np.ndarray, key: np.ndarray, place: np.ndarray, degree: np.ndarray,
               value: np.ndarray, n: np.ndarray) -> bytes:
        """``key`` and ``place`` have ``degree`` entries a node, ``value`` n."""
        keys, key = np.unique(key, return_inverse=True)
        values, value = np.unique(value, return_inverse=True)
        return frame([pack(x) for x in (node, root, n, keys, values, degree, key, place, value)])


def write_blocks(crowds: DataFrame, folder: str) -> DataFrame:
    """(unit, block) of the files made of (unit, block, node, root, lists,
    values), where ``lists`` are pairs (key, place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(batches).combine_chunks()
        node, root = (t[c].to_numpy() for c in ("node", "root"))
        lists, sets = (t[c].combine_chunks() for c in ("lists", "values"))
        sizes = [x.value_lengths().to_numpy().astype(np.int64) for x in (lists, sets)]
        pairs = lists.flatten()
        key, place = (pairs.field(i).to_numpy() for i in (0, 1))
        first = t.slice(0, 1).select(["unit", "block"])
        Folder(folder).write("-".join(map(str, first.to_pylist()[0].values())), Block.packed(
            node, root, key, place, sizes[0], sets.flatten().to_numpy(), sizes[1]))
        yield from first.to_batches()

    return (crowds.select("unit", "block", "node", "root", "lists", "values").groupBy("unit", "block")
            .applyInArrow(run, "unit string, block long"))


def linked(a: Block, b: Block, similarity: float, sketch: int, few: int, bounds) -> Iterator[tuple[int, int]]:
    """Links between nodes of two blocks (or of one) that join all components
    that their links join; nodes of one root are in one component already.

    Pairs are tried that share as many lists as ``bounds`` asks for, ``few`` at
    most at the places where the first common values must be.
    """
    part, same, size = round(100 * similarity), a is b, len(b.node)
    key_of, value_of = places_in(b.keys, a.keys)[a.key], places_in(b.values, a.values)[a.value]
    mark = np.zeros(len(b.values) + 1, np.int32)  # the last one is for values that b lacks
    label = np.unique(np.concatenate([a.root, b.root]), return_inverse=True)[1]
    label_a = label[:len(a.node)]
    label_b = label_a if same else label[len(a.node):]
    reach_a, reach_b = np.full((2, size), -1, np.int64)
    for i, n in enumerate(a.n.tolist()):
        at = np.arange(a.key_at[i], a.key_at[i + 1])
        at = at[key_of[at] >= 0]
        key = key_of[at]
        sizes = b.list_at[key + 1] - b.list_at[key]
        rows = ranges(b.list_at[key], sizes)
        other = b.list_owner[rows]
        shared = np.bincount(other, minlength=size)
        some = np.flatnonzero(shared)
        m = b.n[some]
        fits = (label_b[some] != label_a[i]) & (np.minimum(n, m) * 100 >= np.maximum(n, m) * part)
        some = some[fits & (some > i)] if same else some[fits]
        if not len(some):
            continue
        common, least = bounds(n, b.n[some], similarity)
        enough = shared[some] >= least
        some, common, least = some[enough], common[enough], np.minimum(few, least[enough])
        reach_a[some] = min(n, sketch) - common + least
        reach_b[some] = np.minimum(b.n[some], sketch) - common + least
        first = (np.repeat(a.place[at], sizes) < reach_a[other]) & (b.list_place[rows] < reach_b[other])
        reach_a[some] = -1
        some = some[np.bincount(other[first], minlength=size)[some] >= least]
        if not len(some):
            continue
        values = value_of[a.at[i]:a.at[i + 1]]
        mark[values] = 1
        if 3 * len(some) > size:
            both = np.add.reduceat(mark[b.value], b.at[:-1])[some]
        else:
            both = np.add.reduceat(mark[b.value[ranges(b.at[some], b.n[some])]], starts(b.n[some])[:-1])
        mark[values] = 0
        hits = some[both * 100 >= (n + b.n[some] - both) * part]
        for old, j in zip(*np.unique(label_b[hits], return_index=True)):
            yield int(a.node[i]), int(b.node[hits[j]])
            for labels in (label_a,) if same else (label_a, label_b):
                labels[labels == old] = label_a[i]


def block_links(written: DataFrame, folder: str, similarity: float, sketch: int, few: int, bounds,
                tasks: int) -> DataFrame:
    """(a, b) of links within each unit of the written blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Block] = {}
        for t in batches:
            for unit, *two in zip(*t.to_pydict().values()):
                names = [f"{unit}-{block}" for block in two]
                held = {x: held.get(x) or Block(Folder(folder).read(x)) for x in names}
                found = list(linked(*(held[x] for x in names), similarity, sketch, few, bounds))
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)],
                                                 names=["a", "b"])

    other = written.withColumnRenamed("block", "block_b")
    pairs = written.join(other, "unit").where("block <= block_b").select("unit", "block", "block_b")
    return pairs.repartition(tasks).mapInArrow(run, "a long, b long")
