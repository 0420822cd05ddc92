"""Repair of conversations to the role grammar ``(s? (u a)+)?``.

A generalised LR parse runs over the rows of a conversation: each row may be
kept, rerolled to user or assistant, or deleted, and rows may be inserted, at
the weights below. All stacks that are possible so far form a graph; stacks
with equal tops are merged, and the one of minimum (cost, audit) goes on. The
audit is the string of the edits' initials (Delete, Insert, Keep, Rerole).

Rows are cut into ranges of (conversation, turn, role, digest), so a long
conversation lies in many; a range's part of it is parsed from each of the
four stacks that it may begin with, and the parts are put together in order.
Repeated texts are found by their digests, pre-aggregated. Only narrow rows
take part in this; the texts are shuffled once, with the conversation's parts
before them, and stream past its audit. The digest of a repaired conversation
is a chain over its lines, so this last step reads one conversation in one
task, line by line; nothing but its audit is held.

Cases: null and empty texts are blank, a null role is a role that fits
nowhere, a null conversation is one of its own, null turns come first; rows of
one turn follow each other by role and digest of the text; repeated rows are
duplicates; very long texts pass line by line; an empty table gives no rows;
other columns, whatever their names, are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from .common import batched, read_table

DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1  # costs; keeping is free
ROLES = {"u": "user", "a": "assistant"}
ADJACENT = frozenset(("su", "ua", "au"))
_SPACES = " \t\n\x0b\x0c\r"

# LR(0) tables of: done -> asked a; asked -> u | s u | done u. Accepted: the
# empty stack and ``done``.
START, SYSTEM, ASKED, DONE, U, S_U, DONE_U, ASKED_A = range(8)
SHIFT = {START: {"s": SYSTEM, "u": U}, SYSTEM: {"u": S_U}, ASKED: {"a": ASKED_A}, DONE: {"u": DONE_U}}
REDUCE = {U: (ASKED, 1), S_U: (ASKED, 2), DONE_U: (ASKED, 2), ASKED_A: (DONE, 2)}  # (goto from the start, length)
ACCEPTED = (START, DONE)


class Stack:
    """A node of the graph: a top and the stack below it."""

    __slots__ = ("state", "below", "_next")

    def __init__(self, state: int, below: Stack | None = None):
        self.state, self.below, self._next = state, below, {}

    def push(self, symbol: str) -> Stack | None:
        """Shift a role and reduce; None if it doesn't fit."""
        if symbol not in self._next:
            state = SHIFT[self.state].get(symbol)
            node = None if state is None else Stack(state, self)
            while node is not None and node.state in REDUCE:
                goto, length = REDUCE[node.state]
                for _ in range(length):
                    node = node.below
                node = Stack(goto, node)
            self._next[symbol] = node
        return self._next[symbol]

    def forced(self) -> str:
        """The role that an inserted or rerolled row takes here."""
        return "u" if self.push("u") else "a"


_EMPTY = Stack(START)
ENTRIES = {START: _EMPTY, SYSTEM: _EMPTY.push("s"), ASKED: _EMPTY.push("u"), DONE: _EMPTY.push("u").push("a")}


class Written:
    """First part of an audit, shared by the stacks that came from it. Parts
    of one length are compared by ``rank``, so no long strings are."""

    __slots__ = ("before", "text", "rank")

    def __init__(self, before: Written | None, text: str, rank: int = 0):
        self.before, self.text, self.rank = before, text, rank

    def whole(self, tail: str) -> str:
        parts, node = [tail], self
        while node is not None:
            parts.append(node.text)
            node = node.before
        return "".join(reversed(parts))


@dataclass
class Top:
    stack: Stack
    cost: int
    written: Written
    tail: str

    def better(self, cost: int, written: Written, tail: str) -> bool:
        """Whether another (cost, audit) is less. Audits of equal cost and top
        never begin with each other: inserts would make the longer dearer."""
        if cost != self.cost:
            return cost < self.cost
        return tail < self.tail if written is self.written else written.rank < self.written.rank


class Parse:
    """The graph's tops after the rows read so far, from one stack."""

    REBASE = 64

    def __init__(self, entry: Stack = _EMPTY):
        self.tops = {entry.state: Top(entry, 0, Written(None, ""), "")}
        self.rows = 0

    @staticmethod
    def _offer(tops: dict[int, Top], stack: Stack | None, cost: int, source: Top, edit: str) -> None:
        if stack is None:
            return
        held, tail = tops.get(stack.state), source.tail + edit
        if held is None or held.better(cost, source.written, tail):
            tops[stack.state] = Top(stack, cost, source.written, tail)

    def _with_inserts(self) -> dict[int, Top]:
        tops = dict(self.tops)
        for _ in range(2):  # a pair at most; more would come back to a top
            for top in list(tops.values()):
                self._offer(tops, top.stack.push(top.stack.forced()), top.cost + INSERT, top, "I")
        return tops

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        found: dict[int, Top] = {}
        more = TRUNCATED if truncated else 0
        for top in self._with_inserts().values():
            self._offer(found, top.stack, top.cost + DELETE, top, "D")
            if not must_go:
                self._offer(found, top.stack.push(initial), top.cost + more, top, "K")
                if top.stack.forced() != initial:
                    self._offer(found, top.stack.push(top.stack.forced()), top.cost + REROLE + more, top, "R")
        self.tops = found
        self.rows += 1
        if self.rows % self.REBASE == 0:
            self._rebase()

    def _rebase(self) -> None:
        """Move the tails' common length to written parts, ranked anew."""
        shared: dict[int, list[Top]] = {}
        for top in self.tops.values():
            shared.setdefault(id(top.written), []).append(top)
        made: dict[tuple[int, int, str], Written] = {}
        for group in shared.values():
            cut = min(len(t.tail) for t in group)
            for t in group:
                key = (t.written.rank, id(t.written), t.tail[:cut])
                if key not in made:
                    made[key] = Written(t.written, t.tail[:cut])
                t.written, t.tail = made[key], t.tail[cut:]
        for rank, (_, node) in enumerate(sorted(made.items(), key=lambda x: (x[0][0], x[0][2]))):
            node.rank = rank

    def ends(self) -> dict[int, tuple[int, str]]:
        return {s: (t.cost, t.written.whole(t.tail)) for s, t in self._with_inserts().items()}


Moves = dict[tuple[int, int], tuple[int, str]]  # (entry, exit): (cost, audit)


def joined(first: Moves, second: Moves) -> Moves:
    """Moves over two parts that follow each other."""
    found: Moves = {}
    for (a, b), (cost, audit) in first.items():
        for (c, d), (more, rest) in second.items():
            if b == c:
                at = (cost + more, audit + rest)
                found[a, d] = min(found.get((a, d), at), at)
    return found


STATS = ("n", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high")


@dataclass
class Part:
    """A conversation's rows within one range; ``turns`` counts the distinct
    ones that aren't null, ``edge`` has the first and the last role initial."""

    moves: Moves
    n: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    low: int | None = None
    high: int | None = None
    edge: list[str] = field(default_factory=list)

    def before(self, after: Part) -> Part:
        """The two as one; rows are in the order of turns."""
        out = Part(joined(self.moves, after.moves),
                   *[getattr(self, s) + getattr(after, s) for s in STATS[:6]],
                   after.low if self.low is None else self.low, self.high if after.high is None else after.high,
                   (self.edge + after.edge)[::max(1, len(self.edge + after.edge) - 1)])
        if self.edge and after.edge:
            out.illegal += self.edge[-1] + after.edge[0] not in ADJACENT
        out.turns -= self.high is not None and self.high == after.low
        return out

    def best(self) -> tuple[int, str]:
        return min(self.moves[k] for k in ((START, e) for e in ACCEPTED) if k in self.moves)


def parse_part(rows: Iterable[tuple], whole: bool) -> Part:
    """Rows are (turn, role, fault), a fault being blank, duplicate, truncated
    or empty. ``whole``: the conversation begins here."""
    runs = {e: Parse(s) for e, s in ENTRIES.items() if e == START or not whole}
    part, previous = Part({}), None
    for turn, role, fault in rows:
        initial = role[:1]
        part.n += 1
        if fault:
            setattr(part, fault, getattr(part, fault) + 1)
        if previous is not None and previous + initial not in ADJACENT:
            part.illegal += 1
        part.edge = [part.edge[0] if part.edge else initial, initial]
        if turn is not None:
            part.turns += turn != part.high
            part.low, part.high = turn if part.low is None else part.low, turn
        previous = initial
        for run in runs.values():
            run.row(initial, fault in ("blank", "duplicate"), fault == "truncated")
    part.moves = {(e, x): end for e, run in runs.items() for x, end in run.ends().items()}
    return part


def apply_audit(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the repaired conversation, row by row."""
    stack = _EMPTY
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        symbol = role[:1] if edit == "K" else stack.forced()
        yield edit, role if edit == "K" else ROLES[symbol], text
        stack = stack.push(symbol)


def _features(turns: DataFrame, absent: Column) -> DataFrame:
    """Rows with their digest and the faults that a row shows by itself."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
        absent.alias("absent"))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = ~F.right(F.rtrim(F.col("text"), F.lit(_SPACES)), F.lit(1)).isin(".", "!", "?")
    key = F.unhex(F.sha2(F.concat(F.coalesce(F.col("conv").cast("string"), F.lit("-")), F.lit(":"),
                                  F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return rows.withColumns({"dk": key, "fault": F.when(blank, "blank").when(cut, "truncated").otherwise("")})


def _ordered(rows: DataFrame, home: str) -> DataFrame:
    """Narrow rows in ranges: ``part`` and ``at``, a row's place in its range.
    Equal rows are told apart by the scan's numbering, so that many of them
    are cut, too."""
    spark = rows.sparkSession
    order = ["conv", "turn", "role", "dk", "salt"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = rows.select("conv", "turn", "role", "dk", "fault", "absent", F.monotonically_increasing_id().alias("salt"))
    narrow.write.parquet(f"{home}/narrow")
    place = spark.read.parquet(f"{home}/narrow").repartitionByRange(parts, *order).sortWithinPartitions(*order) \
        .withColumn("at", F.monotonically_increasing_id())
    (place.drop("salt").withColumns({"part": F.shiftright("at", 33).cast("int"),
                                     "at": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))})
     .write.parquet(f"{home}/ordered"))
    return spark.read.parquet(f"{home}/ordered")


def _with_duplicates(ordered: DataFrame) -> DataFrame:
    """Rows whose role and text stand earlier have the fault ``duplicate``."""
    here = F.struct("part", "at")
    repeated = (ordered.where(~F.col("absent")).groupBy("dk").agg(F.min(here).alias("first"), F.count("dk").alias("n"))
                .where(F.col("n") > 1).select("dk", "first"))
    late = F.coalesce(here > F.col("first"), F.lit(False)) & (F.col("fault") != "blank")
    return (ordered.join(repeated, "dk", "left")
            .select("conv", "turn", "role", "absent", "part", "at",
                    F.when(late, "duplicate").otherwise(F.col("fault")).alias("fault")))


_MOVES = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_PARTS = pa.schema([("conv", pa.int64()), ("part", pa.int32()), ("stats", pa.list_(pa.int64())),
                    ("edge", pa.list_(pa.string())), ("moves", _MOVES)])
_PARTS_DDL = ("conv long, part int, stats array<bigint>, edge array<string>, "
              "moves array<struct<entry:int,exit:int,cost:bigint,audit:string>>")


def _by_key(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Runs of rows that agree in their first columns, each as a stream."""
    def all_rows() -> Iterator[tuple]:
        for b in batches:
            yield from zip(*[c.to_pylist() for c in b.columns])

    source, ahead = all_rows(), []

    def run(key: tuple) -> Iterator[tuple]:
        while ahead:
            yield ahead.pop()
            row = next(source, None)
            if row is not None:
                if row[:keys] != key:
                    held.append(row)
                    return
                ahead.append(row)

    held = [row for row in (next(source, None),) if row is not None]
    while held:
        row = held.pop()
        ahead.append(row)
        rows = run(row[:keys])
        yield row[:keys], rows
        for _ in rows:  # what the caller left unread
            pass


def _parts(ordered: DataFrame) -> DataFrame:
    """One row for each conversation and range that has rows of it. Which
    ranges begin within a conversation is told by their ends, one row a range."""
    ends = (ordered.groupBy("part").agg(F.min_by("conv", "at").alias("first"), F.max_by("conv", "at").alias("last"))
            .orderBy("part").collect())
    later = {r["part"]: r["first"] for before, r in zip(ends, ends[1:]) if before["last"] == r["first"]}
    shared = ordered.sparkSession.sparkContext.broadcast(later)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parsed() -> Iterator[tuple]:
            for (number, conv), rows in _by_key(batches, 2):
                whole = shared.value.get(number, ()) != conv  # a tuple equals no conversation
                part = parse_part((r[2:5] for r in rows if not r[5]), whole)
                yield (conv, number, [getattr(part, s) for s in STATS], part.edge,
                       [dict(zip(("entry", "exit", "cost", "audit"), (*k, *v))) for k, v in part.moves.items()])

        for group in batched(parsed(), lambda r: 200 + sum(100 + len(m["audit"]) for m in r[4]), 4 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*group), _PARTS)], schema=_PARTS)

    placed = (_with_duplicates(ordered).select("part", "conv", "turn", "role", "fault", "absent", "at")
              .repartition("part"))
    return placed.sortWithinPartitions("part", "at").mapInArrow(run, _PARTS_DDL)


def _stream(turns: DataFrame, absent: Column) -> DataFrame:
    """Per conversation its parts, then its rows, in order: (conv, kind, part,
    stats, edge, moves, role, text)."""
    home = shared_path(turns.sparkSession, "conversation-repair")
    rows = _features(turns, absent)
    parts = _parts(_ordered(rows, home)).withColumn("kind", F.lit(0))
    texts = rows.where(~F.col("absent")).select("conv", F.lit(1).alias("kind"), "turn", "role", "dk", "text")
    both = parts.unionByName(texts, allowMissingColumns=True).repartition("conv")
    return (both.sortWithinPartitions("conv", "kind", "part", "turn", "role", "dk")
            .select("conv", "kind", "part", "stats", "edge", "moves", "role", "text"))


def _whole(rows: Iterator[tuple]) -> tuple[Part, Iterator[tuple[str, str]]]:
    """A conversation's parts put together, and the stream of its rows."""
    total, ahead = Part({(START, START): (0, "")}), []
    for r in rows:
        if r[1] == 1:
            ahead.append(r)
            break
        moves = {(m["entry"], m["exit"]): (m["cost"], m["audit"]) for m in r[5]}
        total = total.before(Part(moves, *r[3], edge=r[4]))

    def texts() -> Iterator[tuple[str, str]]:
        while ahead:
            yield ahead.pop()[6:8]
        for x in rows:
            yield x[6:8]

    return total, texts()


def repaired_turns(turns: DataFrame, absent: Column | None = None) -> DataFrame:
    """(conv_id, pos, edit, role, text): the rows of the repaired
    conversations, from position 0."""
    out = pa.schema([("conv_id", pa.int64()), ("pos", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                     ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lines() -> Iterator[tuple]:
            for (conv,), rows in _by_key(batches, 1):
                part, texts = _whole(rows)
                for pos, line in enumerate(apply_audit(part.best()[1], texts)):
                    yield (conv, pos, *line)

        for group in batched(lines(), lambda r: 100 + 4 * len(r[4]), 4 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*group), out)], schema=out)

    absent = F.lit(False) if absent is None else absent
    return _stream(turns, absent).mapInArrow(run, "conv_id long, pos long, edit string, role string, text string")


def repair_report(turns: DataFrame, absent: Column | None = None) -> DataFrame:
    """One row a conversation: its faults, the cost and audit of its repair
    and the digest of the repaired rows. Rows for which ``absent`` holds only
    name their conversation."""
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    out = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in counts], ("audit", pa.string()),
                     ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def repaired() -> Iterator[tuple]:
            for (conv,), rows in _by_key(batches, 1):
                part, texts = _whole(rows)
                cost, audit = part.best()
                chain, lead = hashlib.sha256(), ""
                for _, role, text in apply_audit(audit, texts):
                    chain.update(f"{lead}{role}:{text}".encode())
                    lead = "\n"
                gaps = 0 if part.low is None else part.high - part.low + 1 - part.turns
                yield (conv, gaps, part.blank, part.duplicate, part.truncated, part.illegal, cost, audit,
                       chain.hexdigest())

        for group in batched(repaired(), lambda r: 200 + len(r[7]), 4 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*group), out)], schema=out)

    absent = F.lit(False) if absent is None else absent
    return _stream(turns, absent).mapInArrow(
        run, "conv_id long, " + ", ".join(f"{c} long" for c in counts) + ", audit string, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """Rows with the contract's damage; dropped ones have ``absent``."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), blank))
    role, text = F.coalesce(F.col("role"), blank), F.coalesce(F.col("text"), blank)
    kind = F.col("__damage")
    hit = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                       (F.crc32(key.cast("binary")) % 20).alias("__damage"))
    new = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return (hit.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
                       new.alias("text"), (kind == 0).alias("absent"),
                       F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
                       .alias("copy")).drop("copy"))


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return repair_report(damaged(read_table(spark, sf_dir, "conversations")), F.col("absent"))
