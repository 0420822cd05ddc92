"""Near-duplicate documents by bottom-k sketches from one hash function.

1. A document's set holds the 64-bit hashes of its distinct word shingles; its
   sketch is the ``SKETCH`` smallest ones. Documents with equal sets are one
   node from here on.
2. Two sets with a Jaccard similarity of 0.8 or more differ in few of the
   retained values, so under any common order of values they share one of the
   first ``keys_needed`` values of both sketches. The order puts values that
   are rare in the corpus first, by exact counts: chunks of sketches ask shards,
   to which values are dealt by hash, once for each distinct value. Inverted
   lists of these values generate pairs; a value of one node alone has no list.
3. Places in the lists' order bound what two sets can have in common, before a
   pair is made. A sketch of at most ``SKETCH`` values is the full set: such
   pairs are decided at once. For larger sets the smallest values of the two
   sketches' union estimate the similarity and filter pairs; exact Jaccard
   similarities over the full sets verify them.

No list gives all its pairs. First each node is verified against one member
of its lists (the one that it shares most lists with); then all pairs of members
are tried that aren't in one component yet and share as many lists as linked
sets of their sizes must, so a large group of copies costs some pairs a member,
while every pair that could join two components is tried. Pairs of short lists
are rows; nodes that share a list of more than ``CROWD`` are compared by blocks
of arrays (``crowds``), as groups of edited copies that aren't linked have pairs
by the square of their size. There is no cap on lists, pairs or groups.

For two sets of at most ``SKETCH`` values the lists find every link; if one or
both are larger, a pair at the threshold is missed with a probability of about
1e-7.

Cases: null and empty texts have an empty set and are linked with nothing;
a text with fewer words than a shingle has one shingle, its whole sequence.
Rows may repeat, ids too: each row is returned. A null id is never the
smallest one of a component with others; alone its component is null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .common import mix64, text_or_empty, write_table
from .crowds import BLOCK_VALUES, NODE_VALUES, block_links, write_blocks
from .lm_scoring import (_REPLY, _REQUEST, Folder, count_shard, frame, pack, replies_in_order, requests, unframe,
                         unpack)

SKETCH = 256
ESTIMATE_SLACK = 0.13  # 5.2 standard deviations at SKETCH values
SHARED = 3  # lists that a pair must share, if linked sets must share so many
BATCH_BYTES = 4 << 20  # of texts whose sets are made at a time
RARITY_BITS = 22
CHUNK_VALUES = 1 << 20  # retained values that ask for their counts at a time
SHARD_VALUES = 1 << 20  # about so many are counted at a time
CROWD = 32  # lists with more nodes are long: their pairs are tried by blocks
#: Most rows of a table (16 bytes each) that is broadcast.
MAX_BROADCAST_ROWS = 100_000


# -- sets ---------------------------------------------------------------------

class WordHashes(dict):
    """Word to its 64-bit hash, remembered for the words met last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def shingle_set(text: bytes, size: int, hashes: dict) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(h) - size + 1
    out = h[:n] + np.uint64(size)
    for j in range(1, size):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n])
    return np.unique(mix64(out).view(np.int64))


def set_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Some hundred rows and their texts' sets at a time, fewer if the texts
    are long; the text is the last column."""
    hashes = WordHashes()
    for b in batches:
        texts = b.column(b.num_columns - 1).cast(pa.binary())
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at = 0
        while at < b.num_rows:
            reach = int(np.searchsorted(ends, ends[at] - sizes[at] + BATCH_BYTES, "right"))
            n = min(256, max(1, reach - at))
            yield b.slice(at, n), [shingle_set(t.as_py(), size, hashes) for t in texts.slice(at, n)]
            at += n


def cell_of(values: np.ndarray) -> np.ndarray:
    """Cell of each value in the table of counts."""
    return (mix64(values) >> np.uint64(64 - RARITY_BITS)).astype(np.int64)


def least_drawn(n: int, marked: int, drawn: int, miss: float = 1e-7) -> int:
    """So many of ``marked`` of ``n`` values are among ``drawn`` ones at least,
    drawn without replacement, but for a probability of ``miss``."""
    ways, total = 0, math.comb(n, drawn)
    for k in range(max(0, marked + drawn - n), min(marked, drawn) + 1):
        ways += math.comb(marked, k) * math.comb(n - marked, drawn - k)
        if ways > miss * total:
            return k
    return min(marked, drawn)


@cache
def keys_needed(n: int, similarity: float) -> int:
    """How many of the first values two linked sets must share one of.

    A set that is a whole sketch may be linked with a larger one, of whose
    values only ``SKETCH`` are retained: what they have in common may be among
    those that aren't.
    """
    if n <= SKETCH:
        keys = n - math.ceil(similarity * n - 1e-9) + 1
        for larger in range(SKETCH + 1, math.floor(n / similarity + 1e-9) + 1):
            both = math.ceil((n + larger) * similarity / (1 + similarity) - 1e-9)
            keys = max(keys, n - least_drawn(larger, both, SKETCH) + 1)
        return keys
    miss = 1 - similarity
    return min(SKETCH, math.ceil(SKETCH * miss + 5.2 * math.sqrt(SKETCH * miss * similarity)) + 1)


def choose_keys(values: np.ndarray, rarity: np.ndarray, similarity: float) -> np.ndarray:
    """The values of a sketch for the inverted lists: the rarest first."""
    if not len(values):
        return values
    sketch = values[:SKETCH]
    order = np.lexsort((sketch, rarity[cell_of(sketch)]))
    return sketch[order[:keys_needed(len(values), similarity)]]


def sketch_rows(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, text_hash, digest, n, sketch) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in set_batches(batches, size):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s[:SKETCH] for s in sets], pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "digest", "n", "sketch"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("text_hash"),
                        text_or_empty().alias("text"))
            .mapInArrow(run, "doc_id long, text_hash long, digest binary, n long, sketch array<long>"))


def list_rows(nodes: DataFrame, similarity: float, folder: str) -> DataFrame:
    """(node, n, place, key) of the values that each node (node, n, sketch) has
    for the inverted lists: its rarest ones, without those that no other node
    has. ``place`` is the value's place in the order of the whole sketch.

    The sketches are cut into chunks, kept as files below ``folder`` (stored
    nodes are asked for: a task that is run again writes the same chunks)."""
    values = nodes.agg(F.sum(F.least("n", F.lit(SKETCH)))).first()[0] or 0
    shards = max(1, -(-values // SHARD_VALUES))

    def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct values, each one's shard, the values' places, counts."""
        keys, place, counts = np.unique(values.view(np.uint64), return_inverse=True, return_counts=True)
        return keys, (mix64(keys) % np.uint64(shards)).astype(np.int64), place, counts

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def chunk() -> Iterator[pa.RecordBatch]:
            node, n = (np.concatenate([h.column(i).to_numpy() for h in held]) for i in (0, 1))
            values = np.concatenate([h.column(2).flatten().to_numpy() for h in held])
            Folder(folder).write(str(node[0]), frame([pack(node), pack(n), pack(values)]))
            keys, shard, _, counts = distinct(values)
            yield from requests(str(node[0]), shard, [keys, counts])
            held.clear()

        size = 0
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                held.append(b.slice(at, 1024))
                size += len(held[-1].column(2).flatten())
                if size >= CHUNK_VALUES:
                    yield from chunk()
                    size = 0
        if held:
            yield from chunk()

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, got = "", {}
        for b in batches:
            name = b.column(0)[0].as_py()
            got.update((s, unframe(p)[0]) for s, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist()))
        node, n, values = map(unpack, unframe(Folder(folder).read(name)))
        _, shard, place, _ = distinct(values)
        counts = replies_in_order(got, shard)[place]
        sizes = np.minimum(n, SKETCH)
        owner = np.repeat(np.arange(len(n)), sizes)
        order = np.lexsort((values, counts, owner))  # owners stay where they are
        at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        needed = np.array([keys_needed(x, similarity) for x in n.tolist()], np.int64)
        chosen = np.flatnonzero((at < needed[owner]) & (counts[order] > 1))
        who = owner[chosen]
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[who]), pa.array(n[who]), pa.array(at[chosen].astype(np.int32)),
             pa.array(values[order[chosen]])], names=["node", "n", "place", "key"])

    replies = (nodes.select("node", "n", "sketch").mapInArrow(ask, _REQUEST)
               .groupBy("shard").applyInArrow(count_shard(False), _REPLY).where("chunk <> ''"))
    return replies.groupBy("chunk").applyInArrow(choose, "node long, n long, place int, key long")


# -- tables in the shared folder ------------------------------------------------

class Scratch:
    """Tables below one folder of the shared storage; they cut lineage, and
    their shuffle files go when they are written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.made = spark, shared_path(spark, "near-dedup"), 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.made += 1
        path = f"{self.folder}/{self.made}"
        write_table(df, path)
        return self.spark.read.schema(df.schema).parquet(path)


def small_or_not(df: DataFrame) -> DataFrame:
    """``df`` marked for a broadcast if its rows are few enough; otherwise the
    join is left to shuffles."""
    return F.broadcast(df) if df.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS else df


# -- components -------------------------------------------------------------------

def connect(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node with an edge; the root is the smallest node
    of its component. Alternating large-star and small-star steps."""
    stars = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    state = None
    while True:
        both = stars.select("a", "b").unionAll(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionAll(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        stars = scratch.keep(small)
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)


# -- links ------------------------------------------------------------------------

def estimate(a: Column, b: Column) -> Column:
    """Similarity by the smallest values of the sketches' union: the part of
    them that both sketches have."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, SKETCH)
    return F.size(F.array_intersect(union, F.array_intersect(a, b))) / F.greatest(F.size(union), F.lit(1))


def sizes_allow(n_a: Column, n_b: Column, similarity: float) -> Column:
    """Whether sets of these sizes can be linked."""
    return F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * round(100 * similarity)


def least_common(n_a: Column, n_b: Column, similarity: float) -> Column:
    """How many values the sketches of two linked sets have in common at least;
    1 if one of them is a whole set and the other isn't.

    With whole sets as sketches that is exact; two larger sets have a
    hypergeometric part of their sketches in common, here less 5.2 standard
    deviations.
    """
    both = F.ceil((n_a + n_b) * (similarity / (1 + similarity)) - 1e-9)
    most = F.greatest(n_a, n_b)
    part = F.least(both / most, F.lit(1.0))
    rest = F.greatest(F.lit(0.0), 1 - F.lit(float(SKETCH)) / most)  # drawn without replacement
    sampled = F.floor(part * SKETCH - F.sqrt(part * (1 - part) * SKETCH * rest) * 5.2)
    return (F.when((n_a <= SKETCH) & (n_b <= SKETCH), both)
            .when((n_a > SKETCH) & (n_b > SKETCH), sampled).otherwise(1))


def least_shared(n_a: Column, n_b: Column, similarity: float) -> Column:
    """How many lists two linked sets of these sizes share at least.

    In any order of the sketches' values the t-th common one is among the
    first ``t + size - common`` of each sketch.
    """
    common = least_common(n_a, n_b, similarity)

    def exact(n: Column) -> Column:
        return common - F.ceil(n * similarity - 1e-9) + 1

    return (F.when((n_a <= SKETCH) & (n_b <= SKETCH), F.least(exact(n_a), exact(n_b)))
            .when((n_a > SKETCH) & (n_b > SKETCH), common - (SKETCH - keys_needed(SKETCH + 1, similarity)))
            .otherwise(1))


def bounds(n: int, others: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """``least_common`` and ``least_shared`` of a set of n values and each of
    others."""
    both = np.ceil((n + others) * (similarity / (1 + similarity)) - 1e-9)
    most = np.maximum(n, others)
    small = others <= SKETCH
    if n <= SKETCH:
        return np.where(small, both, 1), np.where(small, both - np.ceil(most * similarity - 1e-9) + 1, 1)
    part = np.minimum(both / most, 1.0)
    rest = np.maximum(0.0, 1 - SKETCH / most)
    common = np.floor(part * SKETCH - np.sqrt(part * (1 - part) * SKETCH * rest) * 5.2)
    return np.where(small, 1, common), np.where(small, 1, common - (SKETCH - keys_needed(SKETCH + 1, similarity)))


def first_places(at: Column, n: Column, n_a: Column, n_b: Column, shared: Column, similarity: float) -> Column:
    """Whether a place in a set of n values is among those where the first
    ``shared`` common values of two linked sets must be."""
    return at < F.least(n, F.lit(SKETCH)) - least_common(n_a, n_b, similarity) + shared


def places_allow(at_a: Column, n_a: Column, at_b: Column, n_b: Column, similarity: float) -> Column:
    """Whether two sets with a common value at these places of their sketches,
    in the lists' order, can be linked: what they have in common before it is
    at most the shorter beginning, and after it the shorter rest."""
    rest = F.least(F.least(n_a, F.lit(SKETCH)) - at_a, F.least(n_b, F.lit(SKETCH)) - at_b)
    return F.least(at_a, at_b) + rest >= least_common(n_a, n_b, similarity)


def full_sets(docs: DataFrame, wanted: DataFrame, most: int, size: int) -> DataFrame:
    """(node, values) of the wanted (doc_id, digest, node), ``most`` rows at
    most, computed again from the texts; other texts don't leave the scan if
    the wanted rows are few enough for a broadcast."""
    hint = F.broadcast if most <= MAX_BROADCAST_ROWS else (lambda df: df)
    ids = hint(wanted.select(F.col("doc_id").alias("__id")).distinct())
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
            .join(ids, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in set_batches(batches, size):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "digest", "values"])

    found = rows.mapInArrow(run, "doc_id long, digest binary, values array<long>")
    return (found.join(hint(wanted.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "node")),
                       F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest")))
            .select("node", "values"))


def both_ends(pairs: DataFrame) -> DataFrame:
    """(node) of each node of the pairs."""
    return pairs.select("a").unionAll(pairs.select("b")).toDF("node").distinct()


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, similarity: float, repeats: bool,
             scratch: Scratch) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough. A sketch
    of at most ``SKETCH`` values is a full set; sketches of larger sets filter
    the pairs for which full sets are made. ``repeats``: whether a node's row
    may be there several times."""
    part = round(100 * similarity)

    def similar(both: Column, n_a: Column, n_b: Column) -> Column:
        return both * 100 >= (n_a + n_b - both) * part

    pairs = scratch.keep(pairs)
    either = scratch.keep(both_ends(pairs))
    if either.isEmpty():
        return pairs
    # Only the sketches of these nodes leave the scan.
    some = scratch.keep(nodes.join(small_or_not(either), "node", "left_semi"))
    left = some.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    right = some.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    whole = F.greatest("n_a", "n_b") <= SKETCH
    near = (F.when(whole, similar(F.size(F.array_intersect("s_a", "s_b")), F.col("n_a"), F.col("n_b")))
            .otherwise(estimate(F.col("s_a"), F.col("s_b")) >= similarity - ESTIMATE_SLACK))
    passed = scratch.keep(left.join(pairs, "a").join(right, "b").where(near).select("a", "b", whole.alias("whole")))
    done, hopeful = passed.where("whole").select("a", "b"), passed.where("not whole").select("a", "b")
    found = hopeful.count()
    if not found:
        return done
    sets = full_sets(docs, some.select("node", "doc_id", "digest").join(both_ends(hopeful), "node"), 2 * found, size)
    sets = scratch.keep(sets.dropDuplicates(["node"]) if repeats else sets)
    first = sets.select(F.col("node").alias("a"), F.col("values").alias("v_a")).join(hopeful, "a")
    heads = hopeful.select("b").distinct()
    second = sets.select(F.col("node").alias("b"), F.col("values").alias("v_b")).join(heads, "b")
    return done.unionAll(scratch.keep(
        first.join(second, "b").where(similar(F.size(F.array_intersect("v_a", "v_b")), F.size("v_a"), F.size("v_b")))
        .select("a", "b")))


def crowd_links(within: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, similarity: float, repeats: bool,
                scratch: Scratch) -> DataFrame:
    """Links (a, b) between nodes of different roots that share a long list, so
    many that they join all components that such links join. ``within``: (key,
    node, n, place, root, least, open) of the lists of several roots, with the
    smallest root of a list and how many nodes it has.

    A crowd are the nodes that long lists connect. Its nodes are dealt to
    blocks; crowds of less than a block share one.
    """
    long = within.where(F.col("open") > CROWD)
    edges = long.select(F.col("root").alias("a"), F.col("least").alias("b"))
    crowd_of = connect(edges, scratch).select(F.col("node").alias("root"), F.col("root").alias("crowd"))
    crowds = scratch.keep(long.select("node", "root", "n").distinct().join(small_or_not(crowd_of), "root"))
    sizes = scratch.keep(crowds.groupBy("crowd").agg((F.sum(F.col("n") + NODE_VALUES) / BLOCK_VALUES).alias("blocks")))
    bins = math.ceil(sizes.where("blocks <= 1").agg(F.sum("blocks")).first()[0] or 1)
    alone = F.col("blocks") > 1
    dealt = scratch.keep(
        crowds.join(small_or_not(sizes), "crowd")
        .select("node", "root",
                F.when(alone, F.concat(F.lit("crowd"), "crowd"))
                .otherwise(F.concat(F.lit("bin"), F.pmod(F.xxhash64("crowd"), F.lit(bins)))).alias("unit"),
                F.when(alone, F.pmod(F.xxhash64("node"), F.ceil("blocks"))).otherwise(F.lit(0)).alias("block")))
    lists = (within.join(small_or_not(dealt.select("node")), "node", "left_semi").groupBy("node")
             .agg(F.collect_list(F.struct("key", "place")).alias("lists")))
    wanted = nodes.select("node", "doc_id", "digest").join(small_or_not(dealt.select("node")), "node", "left_semi")
    sets = full_sets(docs, wanted, dealt.count(), size)
    if repeats:
        sets = scratch.keep(sets).dropDuplicates(["node"])
    folder = f"{scratch.folder}/blocks"
    written = scratch.keep(write_blocks(dealt.join(lists, "node").join(sets, "node"), folder))
    tasks = written.groupBy("unit").count().agg(F.sum(F.expr("count * (count + 1) / 2"))).first()[0]
    most = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return scratch.keep(block_links(written, folder, similarity, SKETCH, SHARED, bounds, max(1, min(int(tasks), most))))


def components(docs: DataFrame, shingle: int, similarity: float, scratch: Scratch) -> DataFrame:
    """(doc_id, text_hash, n, row, root) of every row; a component's rows have
    one root, and a row without shingles is a component of its own."""
    rows = scratch.keep(sketch_rows(docs, shingle).withColumn("row", F.monotonically_increasing_id()))
    filled = rows.where("n > 0")
    # One node for each distinct set, named after one of its rows.
    nodes_of = scratch.keep(filled.groupBy("digest").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("copies")))
    copies = (filled.select("digest", "row").join(nodes_of.where("copies > 1"), "digest").where("row <> node")
              .select("row"))
    nodes = (filled.join(small_or_not(scratch.keep(copies)), "row", "left_anti")
             .select(F.col("row").alias("node"), "n", "sketch"))

    # Inverted lists of two nodes or more. The node that is in most lists leads
    # a list: an original shares more of its values than its edited copies.
    lists = scratch.keep(list_rows(nodes, similarity, f"{scratch.folder}/chunks"))
    shared = lists.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("key")
    members = scratch.keep(lists.join(shared, "key"))
    degree = members.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    leaders = (members.join(degree, "node").groupBy("key")
               .agg(F.max_by(F.struct("node", "n", "place"), F.struct("degree", -F.col("node"))).alias("led"))
               .select("key", *[F.col(f"led.{c}").alias(c + "_b") for c in ("node", "n", "place")]))
    repeats = not (filled.join(small_or_not(nodes_of.where("copies > 1").select("digest")), "digest", "left_semi")
                   .groupBy("digest", "doc_id").count().where("count > 1").isEmpty())
    sketches = rows.select(F.col("row").alias("node"), "doc_id", "digest", "n", "sketch")
    check = (sketches, docs, shingle, similarity, repeats, scratch)

    def may_be_linked() -> Column:
        """Of rows of the lists and others of the same list (``_b``)."""
        sizes = F.col("n"), F.col("n_b")
        return (sizes_allow(*sizes, similarity)
                & places_allow(F.col("place"), sizes[0], F.col("place_b"), sizes[1], similarity))

    def needed() -> Column:
        return F.least(F.lit(SHARED), least_shared(F.col("n"), F.col("n_b"), similarity))

    def at_first_places() -> Column:
        sizes = F.col("n"), F.col("n_b")
        return (first_places(F.col("place"), sizes[0], *sizes, needed(), similarity)
                & first_places(F.col("place_b"), sizes[1], *sizes, needed(), similarity))

    def counted(joined: DataFrame, least: Column) -> DataFrame:
        """(a, b, shared) of the pairs that share as many lists as linked sets
        must."""
        return (joined.withColumn("least", least)
                .groupBy(F.greatest("node", "node_b").alias("a"), F.least("node", "node_b").alias("b"))
                .agg(F.count(F.lit(1)).alias("shared"), F.first("least").alias("least"))
                .where(F.col("shared") >= F.col("least")).select("a", "b", "shared"))

    # Each node against the leader that it shares most lists with. A leader may
    # follow another one, in the pair (node, leader) or (leader, node).
    led = counted(members.join(leaders, "key").where((F.col("node") != F.col("node_b")) & may_be_linked()), F.lit(1))
    best = (led.unionAll(led.select(F.col("b").alias("a"), F.col("a").alias("b"), "shared"))
            .join(leaders.select(F.col("node_b").alias("b")).distinct(), "b", "left_semi")
            .groupBy("a").agg(F.max_by("b", F.struct("shared", -F.col("b"))).alias("b")))
    links = verified(best, *check)
    stars = connect(links, scratch)
    # Later, the pairs of nodes that aren't in one component yet: those of short
    # lists as rows, those of nodes that share a long list by blocks of arrays.
    labelled = (members.join(stars, "node", "left")
                .select("key", "node", "n", "place", F.coalesce("root", "node").alias("root")))
    mixed = scratch.keep(labelled.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"),
                                                     F.count(F.lit(1)).alias("open"))
                         .where("least <> most").select("key", "least", "open"))
    if not mixed.isEmpty():
        within = scratch.keep(labelled.join(mixed, "key"))
        short = within.where(F.col("open") <= CROWD)
        others = short.select("key", *[F.col(c).alias(c + "_b") for c in ("node", "n", "place", "root")])
        pairs = counted(short.join(others, "key")
                        .where((F.col("root") != F.col("root_b")) & (F.col("node") > F.col("node_b"))
                               & may_be_linked() & at_first_places()), needed())
        more = verified(pairs.select("a", "b"), *check)
        if not mixed.where(F.col("open") > CROWD).isEmpty():
            more = scratch.keep(more.unionAll(crowd_links(within, *check)))
        if not more.isEmpty():
            stars = connect(stars.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(more), scratch)

    grouped = nodes_of.join(stars, "node", "left").select("digest", F.coalesce("root", "node").alias("root"))
    return scratch.keep(rows.select("doc_id", "text_hash", "digest", "n", "row").join(grouped, "digest", "left")
                        .select("doc_id", "text_hash", "n", "row",
                                F.when(F.col("n") > 0, F.col("root")).otherwise(F.col("row")).alias("root")))


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) of every row;
    ``text_hash`` is the xxhash64 of the text."""
    placed = components(docs, shingle, similarity, Scratch(docs.sparkSession))
    smallest = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return (placed.join(smallest, "root")
            .select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def keep_one(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of each component: the one with the smallest doc_id (nulls
    last), then the smallest hash of its text."""
    scratch = Scratch(docs.sparkSession)
    placed = components(docs, shingle, similarity, scratch)
    first = F.struct(F.col("doc_id").isNull().alias("lacks"), "doc_id", "text_hash")
    # Rows of one id and text are in one component, but those without shingles,
    # each of which is one.
    kept = (placed.where("n > 0").groupBy("root").agg(F.min(first).alias("f"))
            .select(F.col("f.doc_id").alias("__id"), F.col("f.text_hash").alias("__hash")))
    alike = (placed.where("n > 0").groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
             .count().where("count > 1").select("__id", "__hash", F.lit(True).alias("__repeated")))
    same = F.col("k.__id").eqNullSafe(F.col("r.__id")) & (F.col("k.__hash") == F.col("r.__hash"))
    bare = (placed.where("n = 0").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
            .withColumn("__repeated", F.lit(False)))
    kept = scratch.keep(kept.alias("k").join(alike.alias("r"), same, "left")
                        .select("k.__id", "k.__hash", F.coalesce("__repeated", F.lit(False)).alias("__repeated"))
                        .unionAll(bare))

    def chosen(some: DataFrame) -> DataFrame:
        return docs.join(small_or_not(some), F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
                         & (F.xxhash64(text_or_empty()) == F.col("__hash")), "left_semi")

    once, repeated = kept.where("not __repeated"), kept.where("__repeated")
    if repeated.isEmpty():
        return chosen(once)
    return chosen(once).unionAll(chosen(repeated).dropDuplicates(["doc_id", "text"]))
