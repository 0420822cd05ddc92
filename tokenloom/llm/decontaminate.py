"""Benchmark decontamination with DataFrame functions only.

Texts are normalised to words (A-Z lower-cased; runs of digits, letters a-z
and characters beyond ASCII). A window is ``size`` consecutive words of a
benchmark item, or a whole shorter item. The set of the windows' hashes is
sent to all tasks as a literal as long as it has ``MAX_SET`` members at most;
each document scans its windows against it within its row. The few windows
that are found are verified by their words in a join with the benchmark's
windows. A larger benchmark is joined by all windows instead, in a shuffle.

Cases: a null text has no words and is clean; items without words are left
out; a document shorter than every window is clean; repeated rows are
returned as often as they occur, each with the same result; rows are told
apart by doc_id (which may be null) and text; an empty benchmark finds
nothing. Other columns of ``docs`` play no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

SIZE = 10
#: Most window hashes that are sent with the plan (8 bytes each).
MAX_SET = 50_000

_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after lower-casing
_ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_ANY_CASE_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Normalised words; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _NO_WORD), "")


def _starts(n: Column, length: int) -> Column:
    """1 .. n - length + 1, or nothing."""
    return F.when(n >= length, F.sequence(F.lit(1), n - (length - 1))).otherwise(F.array().cast("array<int>"))


def _window(words: Column, pos: Column, length) -> Column:
    return F.array_join(F.slice(words, pos, length), " ")


def benchmark_windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(item_id, length, window, hash) of each item's windows."""
    items = (benchmark.select("item_id", words_of(F.col("text")).alias("words"))
             .where(F.size("words") > 0)
             .withColumn("length", F.least(F.size("words"), F.lit(size))))
    placed = items.select("item_id", "length", "words", F.explode(
        F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("pos"))
    return placed.select("item_id", "length", _window(F.col("words"), F.col("pos"), F.col("length")).alias("window"),
                         F.xxhash64(F.transform(F.slice("words", F.col("pos"), F.col("length")),
                                                lambda w: F.xxhash64(w))).alias("hash")).distinct()


def scan_documents(docs: DataFrame, benchmark: DataFrame, size: int = SIZE,
                   max_set: int = MAX_SET, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text_hash, n_words, copies, spans, items) of every distinct
    row: verified spans (pos, length) in words, sorted, and the item ids."""
    windows = benchmark_windows(benchmark, size)
    known = windows.select("length", "hash").distinct().limit(max_set + 1).collect()
    small = len(known) <= max_set
    if small:
        lengths: dict[int, list[int]] = {}
        for r in known:
            lengths.setdefault(r["length"], []).append(r["hash"])
    else:
        lengths = {r[0]: [] for r in windows.select("length").distinct().collect()}  # ``size`` rows at most

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
                       words_of(F.col("text")).alias("words"))
    rows = rows.select("doc_id", "text_hash", "words", F.size("words").alias("n_words"),
                       F.transform("words", lambda w: F.xxhash64(w)).alias("codes"))

    def found(length: int, hashes: list[int]) -> Column:
        starts = _starts(F.col("n_words"), length)
        if small:
            starts = F.filter(starts, lambda i: F.xxhash64(F.slice("codes", i, F.lit(length))).isin(hashes))
        return F.transform(starts, lambda i: F.struct(
            i.alias("pos"), F.lit(length).alias("length"), _window(F.col("words"), i, F.lit(length)).alias("window")))

    row_mark = F.array(F.struct(F.lit(0).alias("pos"), F.lit(0).alias("length"),
                                F.lit(None).cast("string").alias("window")))
    spans = F.concat(row_mark, *[found(n, h) for n, h in sorted(lengths.items())])
    placed = (rows.select("doc_id", "text_hash", "n_words", F.explode(spans).alias("at"))
              .select("doc_id", "text_hash", "n_words", "at.pos", "at.length", "at.window"))
    by_window = windows.groupBy("window").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    hit = placed.join(F.broadcast(by_window) if small else by_window, "window", "left")
    hit = hit.where((F.col("pos") == 0) | F.col("items").isNotNull())
    span = F.when(F.col("pos") > 0, F.struct("pos", "length"))
    return (hit.groupBy("doc_id", "text_hash", "n_words")
            .agg(F.count(F.when(F.col("pos") == 0, 1)).alias("copies"),
                 F.sort_array(F.collect_set(span)).alias("spans"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))


def covered(spans: Column) -> Column:
    """Words inside any of the sorted spans."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(spans, start, lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["pos"] + s["length"] - 1 - F.greatest(acc["end"], s["pos"] - 1))).alias("n"),
        F.greatest(acc["end"], s["pos"] + s["length"] - 1).alias("end")), lambda acc: acc["n"])


def contamination_report(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every
    document."""
    found = scan_documents(docs, benchmark, size)
    return (found.withColumn("n_hit", covered(F.col("spans")).cast("long"))
            .select("doc_id", F.col("n_words").cast("long").alias("n_words"), "n_hit",
                    F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"),
                    F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
            .drop("copy"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = SIZE,
                      id_col: str = "doc_id") -> DataFrame:
    """``docs`` without those that hold a window; all columns as they were."""
    bad = (scan_documents(docs, benchmark, size, id_col=id_col).where(F.size("spans") > 0)
           .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")))
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("__id"))
                     & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__hash")), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with the words of verified spans (and what separates them from
    the next word) cut out of the text; clean texts stay as they were."""
    bad = (scan_documents(docs, benchmark, size, id_col=id_col).where(F.size("spans") > 0)
           .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("spans").alias("__spans")))
    joined = docs.join(bad, F.col(id_col).eqNullSafe(F.col("__id"))
                       & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__hash")), "left")
    parts = F.regexp_extract_all("text", F.lit(f"{_ANY_CASE_WORD}|{_ANY_CASE_GAP}"), F.lit(0))
    first_is_gap = F.col("text").rlike(f"^{_ANY_CASE_GAP}").cast("int")
    # Words and gaps alternate: the number of the word that part i is, or follows.
    kept = F.filter(parts, lambda part, i: ~F.exists("__spans", lambda s: (
        F.floor((i + 2 - first_is_gap) / 2) >= s["pos"]) & (
        F.floor((i + 2 - first_is_gap) / 2) < s["pos"] + s["length"])))
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(F.array_join(kept, ""))
    return joined.withColumn("text", text).select(*docs.columns)


_SQL_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE_SQL = f"""
with d as (select row_number() over () as rid, doc_id, {_SQL_WORDS} as w from documents),
b as (select item_id, {_SQL_WORDS} as w from benchmark),
bw as (select distinct item_id, least(len(w), {SIZE}) as k, array_to_string(w[i:i + least(len(w), {SIZE}) - 1], ' ') as win
  from (select item_id, w, unnest(generate_series(1, greatest(len(w) - {SIZE - 1}, 1))) as i from b where len(w) > 0)),
dw as (select rid, i, k, array_to_string(w[i:i + k - 1], ' ') as win
  from (select rid, w, k, unnest(generate_series(1, len(w) - k + 1)) as i
        from d, (select distinct k from bw) where len(w) >= k)),
h as (select rid, i, dw.k as k, item_id from dw join bw on dw.win = bw.win and dw.k = bw.k),
words as (select rid, count(distinct p) as n_hit from
  (select rid, unnest(generate_series(i, i + k - 1)) as p from h) group by rid),
items as (select rid, count(*) as n_items, sha256(string_agg(s, ',' order by s)) as items_sha256
  from (select distinct rid, cast(item_id as varchar) as s from h) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (rid) left join items using (rid)
"""
