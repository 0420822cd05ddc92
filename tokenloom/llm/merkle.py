"""Merkle manifest of a dataset: a root, and a proof for each row.

Rows are leaves, ordered by id within their group; every ``arity`` consecutive
nodes become their digest until one remains, the group's subroot, and the
subroots in the order of their groups likewise give the root.

The tree is a rollup. A node's rank within its tree is written as a block
number and ``levels`` digit columns; the digits are grouped away one after
the other, and each grouping nests the structs of the children in their
parent's. One exchange by block serves all groupings of a round, and a block
holds ``arity ** levels`` nodes at most, however large its group is. The next
round does the same with the blocks' digests. Proofs come back from the nested
structs: a transform from the top of a block to its leaves adds the siblings'
digests to the path, and an explode returns the rows; a block and the path
above it meet in a grouping by block. There is no join of data; the only one
is with the broadcast table of ranges (one row a shuffle partition).

Ranks: rows are cut into ranges of (group, id, digest of the leaf) and sorted
within them; a range's row count and those of its first and last group are
all that reaches the driver. A group, a repeated id or copies that hold a
third of the rows are spread over many ranges.

Cases: a null or empty value has its own encoding; null groups and null ids
come first; rows of one id follow each other by their leaf's digest, and equal
rows are leaves of their own; very long texts are only hashed; an empty table
gives no rows; other columns, whatever their names, are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_path
from .common import read_table

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 2
LEVELS = 10  # of a block, which holds ARITY ** LEVELS nodes at most
PATH = "array<struct<before:string,after:string>>"


def encoded(value: Column) -> Column:
    """``-`` if null, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """Root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, from the leaf's level to the root's."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def _ranges(leaves: DataFrame) -> DataFrame:
    """Add ``part`` and ``at``: a row's range and its place in it."""
    order = ["grp", "id", "leaf", "salt"]
    parts = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = leaves.repartitionByRange(parts, *order).sortWithinPartitions(*order) \
        .withColumn("at", F.monotonically_increasing_id())  # partition << 33 + row in it
    return place.drop("salt").withColumns({"part": F.shiftright("at", 33).cast("int"),
                                           "at": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))})


def _range_rows(ranged: DataFrame) -> tuple[list[tuple], int, int]:
    """One row a range: (range, groups before its first, rows of its first
    group before it, all rows of its first and of its last group, number of
    its groups); the number of groups; the rows of the largest."""
    spans = ranged.groupBy("part", "grp").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("lo"))
    ends = F.struct(F.sha2(encoded(F.col("grp")), 256).alias("key"), F.col("n"))
    found = (spans.groupBy("part").agg(F.min_by(ends, "lo").alias("first"), F.max_by(ends, "lo").alias("last"),
                                       F.count(F.lit(1)).alias("groups"), F.max("n").alias("largest"))
             .orderBy("part").collect())
    total, before, groups, rows, previous = {}, {}, 0, [], None
    for r in found:
        for key, n in dict([r["first"], r["last"]]).items():
            total[key] = total.get(key, 0) + n
    for r in found:
        ordinal = groups - (r["first"]["key"] == previous)
        rows.append((r["part"], ordinal, before.get(r["first"]["key"], 0), total[r["first"]["key"]],
                     total[r["last"]["key"]], r["groups"]))
        for key, n in dict([r["first"], r["last"]]).items():
            before[key] = before.get(key, 0) + n
        groups, previous = ordinal + r["groups"], r["last"]["key"]
    return rows, groups, max([*total.values(), *(r["largest"] for r in found)], default=0)


def _ranked(ranged: DataFrame, rows: list[tuple]) -> DataFrame:
    """(tree, rank, n, h, payload) of the leaves: ordinal of the group, rank
    in it and its number of leaves."""
    known = F.broadcast(ranged.sparkSession.createDataFrame(
        rows, "part int, ordinal long, earlier long, first_n long, last_n long, groups long"))
    by_group = Window.partitionBy("part").orderBy("grp")
    peers = by_group.rangeBetween(Window.currentRow, Window.currentRow)
    placed = ranged.withColumns({"nth": F.dense_rank().over(by_group), "start": F.rank().over(by_group) - 1,
                                 "here": F.count(F.lit(1)).over(peers)}).join(known, "part")
    first, last = F.col("nth") == 1, F.col("nth") == F.col("groups")
    return placed.select(
        (F.col("ordinal") + F.col("nth") - 1).alias("tree"),
        (F.col("at") - F.col("start") + F.when(first, F.col("earlier")).otherwise(0)).alias("rank"),
        F.when(first, F.col("first_n")).when(last, F.col("last_n")).otherwise(F.col("here")).alias("n"),
        F.col("leaf").alias("h"), F.struct("id", "carried").alias("payload"))


def _round(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """(tree, block, n, node): blocks of nodes, nested digit by digit. A node
    is a struct of its digest ``h`` and its ``kids`` (leaves: ``payload``)."""
    size = arity ** levels
    digit = [F.floor(F.col("rank") / F.lit(arity ** i)) % arity for i in range(levels)]
    df = nodes.select("tree", F.floor(F.col("rank") / F.lit(size)).alias("block"), "n",
                      *[d.alias(f"d{i}") for i, d in enumerate(digit)],
                      F.struct("h", "payload").alias("node")).repartition("tree", "block")
    for i in range(levels):
        keys = ["tree", "block", "n", *[f"d{j}" for j in range(i + 1, levels)]]
        kids = F.transform(F.array_sort(F.collect_list(F.struct(f"d{i}", "node"))), lambda k: k["node"])
        joined = F.sha2(F.array_join(F.transform("kids", lambda k: k["h"]), ""), 256)
        h = F.when(F.col("n") > arity ** i, joined).otherwise(F.get("kids", F.lit(0))["h"])
        df = df.groupBy(*keys).agg(kids.alias("kids")).select(*keys, F.struct(h.alias("h"), "kids").alias("node"))
    return df


def _leaves_of(node: Column, levels: int, n: Column, path: Column, arity: int) -> Column:
    """Array of (node, path) of the leaves below a node, level by level."""
    def digests(nodes: Column) -> Column:
        return F.array_join(F.transform(nodes, lambda x: x["h"]), "")

    def kids_of(level: int):
        def kids(x: Column) -> Column:
            def kid(k: Column, j: Column) -> Column:
                step = F.struct(digests(F.slice(x["node"]["kids"], F.lit(1), j)).alias("before"),
                                digests(F.slice(x["node"]["kids"], j + 2, F.lit(arity))).alias("after"))
                longer = F.when(n > arity ** (level - 1), F.array(step)).otherwise(F.array().cast(PATH))
                return F.struct(k.alias("node"), F.concat(longer, x["path"]).alias("path"))
            return F.transform(x["node"]["kids"], kid)
        return kids

    found = F.array(F.struct(node.alias("node"), path.alias("path")))
    for level in range(levels, 0, -1):
        found = F.flatten(F.transform(found, kids_of(level)))
    return found


def _down(blocks: DataFrame, above: DataFrame, arity: int, levels: int) -> DataFrame:
    """(payload, h, path, subroot, root) of the leaves of all blocks; ``above``
    has (tree, block, path, subroot, root), one row a block."""
    both = blocks.select("tree", "block", "n", "node").unionByName(above, allowMissingColumns=True)
    met = both.groupBy("tree", "block").agg(*[
        F.first(c, ignorenulls=True).alias(c) for c in ("n", "node", "path", "subroot", "root")])
    found = F.explode(_leaves_of(F.col("node"), levels, F.col("n"), F.col("path"), arity)).alias("x")
    return met.select(found, "subroot", "root").select("x.node.*", "x.path", "subroot", "root")


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: Sequence[str] = FIELDS,
             carry: dict[str, Column] | None = None, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """(id_col, leaf, subroot, root, path, the columns of ``carry``) of every
    row. ``path`` lists, from the leaf up, the digests before and after the
    node on its way; ``fold`` recomputes the root from it."""
    spark, home = docs.sparkSession, shared_path(docs.sparkSession, "merkle")
    carried = {"_": F.lit(None).cast("int")} | (carry or {})

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{home}/{name}")
        return spark.read.parquet(f"{home}/{name}")

    leaves = kept(docs.select(
        F.col(group_col).alias("grp"), F.col(id_col).alias("id"), leaf_digest([F.col(f) for f in fields]).alias("leaf"),
        F.struct(*[c.alias(name) for name, c in carried.items()]).alias("carried"),
        F.monotonically_increasing_id().alias("salt")), "leaves")
    ranged = kept(_ranges(leaves), "ranges")
    rows, n_groups, largest = _range_rows(ranged)

    def rounds(nodes: DataFrame, most: int, name: str) -> tuple[list[tuple], DataFrame]:
        """Blocks of every round with their levels (no more than the largest
        tree needs), and the nodes that remain, one a tree."""
        made = []
        while True:
            deep = next((i for i in range(1, levels) if arity ** i >= most), levels)
            made.append((kept(_round(nodes, arity, deep), f"{name}{len(made)}"), deep))
            most = -(-most // arity ** deep)
            nodes = made[-1][0].select("tree", F.col("block").alias("rank"),
                                       F.ceil(F.col("n") / F.lit(arity ** deep)).alias("n"),
                                       F.col("node.h").alias("h"), F.struct("tree", "block").alias("payload"))
            if most <= 1:
                return made, nodes

    low, subroots = rounds(_ranked(ranged, rows), largest, "group")
    tops = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"),
                           F.lit(n_groups).cast("long").alias("n"), "h", "payload")
    high, _ = rounds(tops, n_groups, "top")

    above = high[-1][0].select("tree", "block", F.array().cast(PATH).alias("path"), F.lit("").alias("subroot"),
                            F.col("node.h").alias("root"))
    for blocks, deep in reversed(high):
        above = _down(blocks, above, arity, deep).select("payload.*", "path", F.col("h").alias("subroot"), "root")
    for blocks, deep in reversed(low[1:]):
        above = _down(blocks, above, arity, deep).select("payload.*", "path", "subroot", "root")
    return _down(low[0][0], above, arity, low[0][1]).select(
        F.col("payload.id").alias(id_col), F.col("h").alias("leaf"), "subroot", "root", "path",
        *[F.col(f"payload.carried.{name}").alias(name) for name in carry or {}])


def tampered_leaf(fields: Sequence[str] = FIELDS) -> Column:
    """Leaf of a row whose n_chars is one more, where 7 divides the crc32 of
    its decimal id; else null."""
    more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return F.when(hit, leaf_digest([more if f == "n_chars" else F.col(f) for f in fields]))


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    found = manifest(read_table(spark, sf_dir, "documents"), carry={"tampered": tampered_leaf()})
    rows = found.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


#: Levels by recursion; the crc32 bit by bit; the fold by ``list_reduce``.
ORACLE_SQL = """
with recursive
enc as (
  select doc_id, lang, n_chars,
    case when doc_id is null then '-' else strlen(doc_id::varchar) || ':' || doc_id::varchar end
    || case when source is null then '-' else strlen(source) || ':' || source end
    || case when lang is null then '-' else strlen(lang) || ':' || lang end as head,
    case when n_chars is null then '-' else strlen(n_chars::varchar) || ':' || n_chars::varchar end as count,
    case when n_chars is null then '-' else strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1)::varchar end as more,
    case when text is null then '-' else strlen(text) || ':' || text end as tail,
    list_reduce(list_prepend(4294967295::bigint, list_transform(range(8 * coalesce(length(doc_id::varchar), 0)),
      lambda i: (ord(substr(doc_id::varchar, (i // 8 + 1)::int, 1)) >> (i % 8)::int) & 1)),
      lambda c, b: xor(c >> 1, case when xor(c & 1, b) = 1 then 3988292384 else 0 end)) as crc
  from documents),
leaves as (
  select doc_id, lang, sha256(head || count || tail) as leaf,
    case when doc_id is not null and xor(crc, 4294967295) % 7 = 0 then sha256(head || more || tail)
         else sha256(head || count || tail) end as shown
  from enc),
ranked as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as rank from leaves),
sub as (
  select 0 as level, lang, rank as idx, leaf as h, count(*) over (partition by lang) as n from ranked
  union all
  select level + 1, lang, idx // 2, sha256(string_agg(h, '' order by idx)), (any_value(n) + 1) // 2
  from sub where n > 1 group by level, lang, idx // 2),
subroots as (
  select lang, h as subroot, row_number() over (order by lang collate "binary" nulls first) - 1 as rank,
    count(*) over () as n from sub where n = 1),
top as (
  select 0 as level, rank as idx, subroot as h, n from subroots
  union all
  select level + 1, idx // 2, sha256(string_agg(h, '' order by idx)), (any_value(n) + 1) // 2
  from top where n > 1 group by level, idx // 2),
low_steps as (
  select r.lang, r.rank, list(case when s.h is null then '-' when s.idx % 2 = 0 then 'L' || s.h else 'R' || s.h end
    order by l.level) as steps
  from ranked r join sub l on l.lang is not distinct from r.lang and l.n > 1 and l.idx = r.rank >> l.level
  left join sub s on s.lang is not distinct from r.lang and s.level = l.level and s.idx = xor(l.idx, 1)
  group by r.lang, r.rank),
top_steps as (
  select r.lang, list(case when s.h is null then '-' when s.idx % 2 = 0 then 'L' || s.h else 'R' || s.h end
    order by l.level) as steps
  from subroots r join top l on l.n > 1 and l.idx = r.rank >> l.level
  left join top s on s.level = l.level and s.idx = xor(l.idx, 1)
  group by r.lang),
paths as (
  select r.doc_id, r.leaf, r.shown, u.subroot, (select h from top where n = 1) as root,
    list_concat(coalesce(a.steps, []), coalesce(b.steps, [])) as steps
  from ranked r join subroots u on u.lang is not distinct from r.lang
  left join low_steps a on a.lang is not distinct from r.lang and a.rank = r.rank
  left join top_steps b on b.lang is not distinct from r.lang)
select doc_id, leaf, subroot, root,
  sha256(array_to_string(list_transform(steps, lambda s: substr(s, 2)), '')) as proof_sha256,
  list_reduce(list_prepend(shown, steps), lambda a, s: sha256(
    case s[1] when 'L' then substr(s, 2) || a when 'R' then a || substr(s, 2) else a end)) as folded_root,
  folded_root = root as verified
from paths
"""
