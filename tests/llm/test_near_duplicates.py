import random
import re
import time

import numpy as np
import pytest
from cases import PROSE, ROWS, docs_frame, empty_docs
from pyspark.sql import functions as F
from tokenloom.llm import bottomk_dedup as K
from tokenloom.llm import crowds

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows, size, similarity=0.8):
    sets = []
    for _, t, _ in rows:
        w = WORD.findall((t or "").encode().lower())
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= round(100 * similarity) * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    out = []
    for a, (i, _, _) in enumerate(rows):
        ids = [r[0] for b, r in enumerate(rows) if find(b) == find(a) and r[0] is not None]
        out.append((i, len(sets[a]), min(ids, default=None)))
    return sorted(out, key=str)


def group(seed, n_groups=12, size=14, words=60):
    """Groups of near copies, chains of edits and documents that share a
    common passage but are not alike."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = [r.choice(vocabulary) for _ in range(25)]
    rows, k = [], 0
    for g in range(n_groups):
        base = [r.choice(vocabulary) for _ in range(words)]
        for c in range(size):
            if g % 3 == 0:
                doc = list(base)
                for _ in range(r.randrange(6)):
                    doc[r.randrange(words)] = r.choice(vocabulary)
            elif g % 3 == 1:  # each is an edit of the one before
                base = list(base)
                base[r.randrange(words)] = r.choice(vocabulary)
                doc = base
            else:
                doc = passage + [r.choice(vocabulary) for _ in range(r.choice([5, 10, 40]))]
            rows.append((r.randrange(10**6), " ".join(doc), 1))
            k += 1
    return rows


@pytest.mark.parametrize("size", [2, 5])
def test_against_brute_force(spark, size):
    rows = ROWS + group(size) + [(90, PROSE + " again", 1), (91, "a b c d e f", 1), (92, "a b c d e", 1)]
    got = K.near_duplicates(docs_frame(spark, rows), size).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, size)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_places_never_rule_out_a_link(spark):
    """Any order of values: at the first places of two sets at the threshold
    are as many common values as asked for."""
    r, rows = random.Random(5), []
    for trial in range(400):
        n_a = r.randrange(5, K.SKETCH + 1)
        n_b = r.randrange(-(-4 * n_a // 5), n_a + 1)
        both = -(-4 * (n_a + n_b) // 9)
        a = list(range(n_a))
        b = r.sample(a, both) + list(range(n_a, n_a + n_b - both)) if both <= n_b else a[:n_b]
        order = list(range(2 * K.SKETCH))
        r.shuffle(order)
        rank = {v: k for k, v in enumerate(order)}
        at_a = {v: k for k, v in enumerate(sorted(a, key=rank.get)[:K.keys_needed(n_a, 0.8)])}
        at_b = {v: k for k, v in enumerate(sorted(b, key=rank.get)[:K.keys_needed(len(b), 0.8)])}
        rows += [(trial, n_a, len(b), at_a[v], at_b[v]) for v in set(at_a) & set(at_b)]
    df = spark.createDataFrame(rows, "t int, n_a int, n_b int, at_a int, at_b int")
    sizes = F.col("n_a"), F.col("n_b")
    all_shared = K.least_shared(*sizes, 0.8)
    few = F.least(F.lit(K.SHARED), all_shared)
    fits = (K.places_allow(F.col("at_a"), sizes[0], F.col("at_b"), sizes[1], 0.8) & K.sizes_allow(*sizes, 0.8))
    first = (K.first_places(F.col("at_a"), sizes[0], *sizes, few, 0.8)
             & K.first_places(F.col("at_b"), sizes[1], *sizes, few, 0.8))
    got = (df.groupBy("t").agg(F.min(fits.cast("int")).alias("fits"), F.sum(first.cast("int")).alias("first"),
                               F.count("*").alias("shared"), F.first(few).alias("few"), F.first(all_shared).alias("all"))
           .collect())
    assert len(got) == 400
    assert all(x.fits == 1 and x.first >= x.few and x.shared >= x.all for x in got)


@pytest.mark.parametrize("words", [150, 300])
def test_sets_about_the_sketch_against_brute_force(spark, words):
    rows = group(words, n_groups=3, size=24, words=words)
    got = K.near_duplicates(docs_frame(spark, rows), 2).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 2)


def test_sets_and_keys():
    h = K.WordHashes()
    assert len(K.shingle_set(b"", 2, h)) == len(K.shingle_set(b" \t\n", 2, h)) == 0
    assert len(K.shingle_set(b"one", 2, h)) == 1 and len(K.shingle_set(b"a b a b a", 2, h)) == 2
    assert (K.shingle_set(b"A b", 2, h) == K.shingle_set(b"a\x0bB", 2, h)).all()
    assert (K.shingle_set(b"a b", 5, h) != K.shingle_set(b"b a", 5, h)).all()
    # Any order: sets of n values with a similarity of 0.8 share one of the first keys.
    for n in range(1, K.SKETCH + 1):
        least = -(-8 * n // 10) if n > 1 else 1
        assert K.keys_needed(n, 0.8) >= n - least + 1
    rarity = np.zeros(1 << K.RARITY_BITS, np.uint8)
    values = K.shingle_set(" ".join(map(str, range(400))).encode(), 2, h)
    assert len(K.choose_keys(values, rarity, 0.8)) == K.keys_needed(400, 0.8) < K.SKETCH


def pairs_about_the_sketch():
    """Pairs at the threshold, one of whose sets may be larger than a sketch:
    a text and the same one with words behind it, and one with other words."""
    rows = []
    for n in range(120, 166):
        for k, m in enumerate(sorted({n + 1, int(n / 0.82), int(n / 0.8)})):
            words = [f"s{n}x{k}x{i}" for i in range(m + 1)]
            rows += [(len(rows), " ".join(words[:n + 1]), 1), (len(rows) + 1, " ".join(words), 1)]
            both = -(-8 * (n + m) // 18)
            other = words[:both + 1] + [f"o{n}x{k}x{i}" for i in range(m - both)]
            rows.append((len(rows), " ".join(other), 1))
    return rows


def test_sets_about_the_size_of_a_sketch(spark):
    rows = pairs_about_the_sketch()
    got = K.near_duplicates(docs_frame(spark, rows), 2).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 2)


def test_keys_of_a_whole_set_and_a_sketch():
    r = np.random.default_rng(3)
    rarity = np.zeros(1 << K.RARITY_BITS, np.uint8)
    for n in range(103, K.SKETCH + 1):
        larger = int(n / 0.8 + 1e-9)
        for m in {larger, (larger + K.SKETCH + 1) // 2} - set(range(K.SKETCH + 1)):
            for _ in range(20):
                values = r.integers(-2**62, 2**62, m)
                a, b = np.sort(values[:n]), np.sort(values)
                rarity[:] = 4
                rarity[K.cell_of(np.setdiff1d(a, b[:K.SKETCH]))] = 0  # what only the smaller set retains is rarer
                assert len(np.intersect1d(K.choose_keys(a, rarity, 0.8), K.choose_keys(b, rarity, 0.8)))
        assert K.keys_needed(n, 0.8) <= K.keys_needed(K.SKETCH + 1, 0.8)


def test_keep_one(spark):
    docs = docs_frame(spark)
    kept = K.keep_one(docs, 2).collect()
    assert K.keep_one(docs, 2).columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept) == sorted(
        ["3", "12", "7", "8", "None", "21", "23", "24", "-4"] + (["9"] if len([
            1 for r in brute(ROWS, 2) if r[0] == 9 and r[2] == 9]) else []))


def test_keep_one_of_each_component(spark):
    far = [" ".join(f"{c}{i}" for i in range(30)) for c in "abcdefg"]
    rows = [(None, t, 1) for t in far[:4]]  # null ids, unlike texts
    rows += [(None, far[0], 2), (None, far[1] + " end", 3)]  # a repeated row and a near copy without ids
    rows += [(50, far[4], 4), (50, far[5], 5), (50, far[5], 6)]  # one id, unlike texts
    rows += [(None, far[6], 7), (60, far[6] + " end", 8)]  # an id goes before none
    rows += [(None, "", 9), (None, None, 10), (70, "", 11), (70, " ", 12), (70, "", 13)]  # linked with nothing
    kept = [(r.doc_id, r.text) for r in K.keep_one(docs_frame(spark, rows), 2).collect()]
    near = [t for i, t in kept if i is None and t and t.startswith("b0 ")]
    assert len(near) == 1 and near[0] in (far[1], far[1] + " end")
    want = [(None, t) for t in (far[0], near[0], far[2], far[3], "", None)]
    want += [(50, far[4]), (50, far[5]), (60, far[6] + " end"), (70, ""), (70, " "), (70, "")]
    assert sorted(kept, key=str) == sorted(want, key=str)


def test_empty(spark):
    assert K.near_duplicates(empty_docs(spark), 2).count() == 0
    assert K.keep_one(empty_docs(spark)).count() == 0


def test_a_kept_table_leaves_no_shuffle(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        found = disk.getAllFiles()
        names = [found.apply(i).getName() for i in range(found.size())]
        return {n.split("_")[1] for n in names if n.startswith("shuffle_")}

    before = shuffled()
    kept = K.Scratch(spark).keep(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before
    assert kept.agg(F.sum("count")).first()[0] == 1000


def test_lists_hold_the_rarest_values_by_exact_counts(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(K, "CHUNK_VALUES", 3000)
    monkeypatch.setattr(K, "SHARD_VALUES", 500)
    r = np.random.default_rng(5)
    common = r.integers(-2**62, 2**62, 1200)
    sketches = []
    for i in range(300):
        own = r.integers(-2**62, 2**62, int(r.integers(0, 20)))
        some = r.choice(common, int(r.integers(1, K.SKETCH - 20)), replace=False)
        sketches.append(np.unique(np.concatenate([own, some])))
    path = str(tmp_path / "nodes")
    spark.createDataFrame([(i, len(s), s.tolist()) for i, s in enumerate(sketches)],
                          "node long, n long, sketch array<long>").repartition(3).write.parquet(path)
    found = K.list_rows(spark.read.parquet(path), 0.8, f"file://{tmp_path}/chunks").collect()
    count = dict(zip(*[x.tolist() for x in np.unique(np.concatenate(sketches), return_counts=True)]))
    wanted = set()
    for i, s in enumerate(sketches):
        order = sorted(s.tolist(), key=lambda v: (count[v], v))[:K.keys_needed(len(s), 0.8)]
        wanted.update((i, len(s), p, v) for p, v in enumerate(order) if count[v] > 1)
    assert len(found) == len(wanted) and {tuple(x) for x in found} == wanted


def edited(seed, copies, words, edits, first_id=0):
    """Copies of one text with some words replaced in each."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [r.choice(vocabulary) for _ in range(words)]
    rows = []
    for c in range(copies):
        doc = list(base)
        for _ in range(edits):
            doc[r.randrange(words)] = r.choice(vocabulary)
        rows.append((first_id + c, " ".join(doc), 1))
    return rows


def test_pairs_of_a_large_group_are_not_rows(spark, monkeypatch):
    tried = []
    verified = K.verified

    def count(pairs, *rest):
        tried.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(K, "verified", count)
    rows = edited(1, 160, 400, 18)
    got = K.near_duplicates(docs_frame(spark, rows), 2).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 2)
    assert sum(tried) < 4 * len(rows)  # of 12,720 pairs


@pytest.mark.parametrize("words,edits", [(60, 2), (150, 6), (400, 16)])
def test_crowds_in_several_blocks_against_brute_force(spark, monkeypatch, words, edits):
    monkeypatch.setattr(K, "CROWD", 3)
    monkeypatch.setattr(K, "BLOCK_VALUES", 9000)
    rows = edited(words, 90, words, edits) + edited(words + 1, 30, words, edits, 1000)
    rows += [(i + 2000, t, k) for i, t, k in group(words, n_groups=4, size=12, words=words)] + rows[:5]
    rows += [(None, rows[7][1] + " end", 1)]
    got = K.near_duplicates(docs_frame(spark, rows), 2).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 2)


def test_blocks_join_what_links_join():
    r = np.random.default_rng(2)
    sets = []
    for g in range(6):
        base = r.integers(-2**62, 2**62, 120 if g % 2 else 500)
        for _ in range(12):
            own = base.copy()
            at = r.choice(len(base), int(len(base) * r.choice([0.05, 0.1, 0.15])), replace=False)
            own[at] = r.integers(-2**62, 2**62, len(at))
            sets.append(np.unique(own))
    keys = [s[:K.SKETCH][:K.keys_needed(len(s), 0.8)] for s in sets]  # any order of the values: that of the sketch
    roots = [i - i % 12 if i % 12 < 2 else i for i in range(len(sets))]  # some are in one component already

    def block(some):
        return crowds.Block(crowds.Block.packed(
            np.array(some), np.array(roots)[some], np.concatenate([keys[i] for i in some]),
            np.concatenate([np.arange(len(keys[i])) for i in some]), np.array([len(keys[i]) for i in some]),
            np.concatenate([sets[i] for i in some]), np.array([len(sets[i]) for i in some])))

    def parts(edges):
        root = list(roots)
        for a, b in edges:
            root = [min(root[a], root[b]) if x in (root[a], root[b]) else x for x in root]
        return root

    def alike(i, j):
        both = len(np.intersect1d(sets[i], sets[j]))
        return 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both)

    every = range(len(sets))
    links = [(i, j) for i in every for j in range(i) if alike(i, j)]
    assert len({*parts(links)}) < len({*roots})
    blocks = [block(list(every[k::3])) for k in range(3)]
    found = [x for i in range(3) for j in range(i, 3)
             for x in crowds.linked(blocks[i], blocks[j], 0.8, K.SKETCH, K.SHARED, K.bounds)]
    assert all(alike(*x) for x in found) and len(found) < len(links)
    assert parts(found) == parts(links)


def test_bounds_are_those_of_the_columns(spark):
    sizes = [1, 2, 5, 100, 205, 255, 256, 257, 300, 320, 1000, 1249]
    df = spark.createDataFrame([(a, b) for a in sizes for b in sizes], "a long, b long")
    for r in df.select("a", "b", K.least_common(F.col("a"), F.col("b"), 0.8).alias("common"),
                       K.least_shared(F.col("a"), F.col("b"), 0.8).alias("shared")).collect():
        if 0.8 <= r.a / r.b <= 1.25:
            common, shared = K.bounds(r.a, np.array([r.b]), 0.8)
            assert (common[0], shared[0]) == (r.common, r.shared)
