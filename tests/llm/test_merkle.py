import hashlib
import zlib
from itertools import groupby

import pytest
from cases import LONG, docs_frame, empty_docs
from pyspark.sql import functions as F
from tokenloom.llm import merkle as M


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes, arity):
    """Root and the siblings (before, after) of every node, level by level."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, a in enumerate(at):
            run = level[a // arity * arity:a // arity * arity + arity]
            paths[i].append(("".join(run[:a % arity]), "".join(run[a % arity + 1:])))
        level = [H(*level[i:i + arity]) for i in range(0, len(level), arity)]
        at = [a // arity for a in at]
    return level[0], paths


def brute(rows, arity=2):
    """rows: (doc_id, source, lang, n_chars, text)."""
    leaves = sorted(((r[2] is not None, (r[2] or "").encode()), (r[0] is not None, r[0] or 0),
                     H(*map(enc, r)), r) for r in rows)
    groups = [list(g) for _, g in groupby(leaves, key=lambda x: x[0])]
    subs = [tree([x[2] for x in g], arity) for g in groups]
    root, tops = tree([s[0] for s in subs], arity)
    return sorted((str(x[3][0]), x[2], s[0], root, [*path, *top]) for g, s, top in zip(groups, subs, tops)
                  for x, path in zip(g, s[1]))


def found(df):
    return sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], [tuple(p) for p in r["path"]])
                  for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")


@pytest.mark.parametrize("arity,levels", [(2, 10), (2, 2), (3, 1), (16, 2)])
def test_rounds_and_groups(spark, arity, levels):
    rows = [(i % 37, "s", ["en", "de", None, f"only {i}"][min(i % 5, 3)] if i % 5 < 3 or i > 100 else "en", i, f"t{i % 60}")
            for i in range(130)]
    got = found(M.manifest(frame(spark, rows), arity=arity, levels=levels))
    assert got == brute(rows, arity)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_few_rows(spark, n):
    rows = [(i, None, "en", 1, "x") for i in range(n)]
    assert found(M.manifest(frame(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    """Null ids, texts and groups, copies of a third of the rows, a long text."""
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "", 0, ""), (2, "é", "é", 2, LONG),
            (2, "é", "ê", 2, "-"), (-7, "a", "Z", 1, "1:a"), *[(5, "s", "en", 4, "copy")] * 30]
    assert found(M.manifest(frame(spark, rows), levels=2)) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert M.manifest(empty_docs(spark)).collect() == []
    docs = docs_frame(spark).withColumns({"path": F.lit(1), "leaf": F.lit("x"), "grp": F.lit(2), "tree": F.lit("y")})
    got = M.manifest(docs, carry={"leaf_too": F.col("leaf")}).collect()
    assert len(got) == docs.count() and {r["leaf_too"] for r in got} == {"x"}


def test_proofs_verify_and_tampering_shows(spark, monkeypatch):
    rows = [(i, "s", "en" if i % 3 else None, None if i % 11 == 0 else i, "text") for i in range(60)] + [(None, "", "", 1, "")]
    monkeypatch.setattr(M, "read_table", lambda *a: frame(spark, rows))
    want = {(r[0], r[1]): r for r in brute(rows)}
    by_id = {str(r[0]): r for r in rows}
    for r in M.op12_merkle_manifest(spark, "").collect():
        doc_id, leaf, subroot, root, path = want[str(r["doc_id"]), r["leaf"]]
        assert (r["subroot"], r["root"]) == (subroot, root)
        assert r["proof_sha256"] == H(*[a + b for a, b in path])
        row = list(by_id[doc_id])
        tampered = row[0] is not None and zlib.crc32(doc_id.encode()) % 7 == 0
        if tampered and row[3] is not None:
            row[3] += 1
        node = H(*map(enc, row))
        for a, b in path:
            node = H(a, node, b)
        assert r["folded_root"] == node and r["verified"] == (node == root)
        assert r["verified"] == (not tampered or row[3] is None)


def test_a_hot_group_is_spread(spark):
    """Ranges of one group, one id and equal rows are all cut."""
    leaves = spark.range(4000).select(F.lit("en").alias("grp"), F.lit(1).alias("id"), F.lit("h").alias("leaf"),
                                      F.col("id").alias("salt"))
    ranged = M._ranges(leaves)
    sizes = [r["count"] for r in ranged.groupBy("part").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 2000
