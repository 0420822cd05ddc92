import hashlib
import random
import re
import zlib
from functools import reduce
from itertools import product

import pytest
from pyspark.sql import functions as F
from tokenloom.llm import conversation_repair as C

SCHEMA = "conv_id long, turn long, role string, text string, part int, kind string, __damage int"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def brute_audit(rows):
    """Least (cost, audit) by trying every edit of every row, with up to two
    inserts before each and at the end. rows: (initial, fault)."""
    best = None
    for edits in product("DKR", repeat=len(rows)):
        if any(e != "D" and f in ("blank", "duplicate") for e, (_, f) in zip(edits, rows)):
            continue
        for gaps in product(range(3), repeat=len(rows) + 1):
            audit = "".join("I" * g + e for g, e in zip(gaps, edits)) + "I" * gaps[-1]
            cost = sum({"D": 3, "K": 0, "R": 2}[e] + (e != "D" and f == "truncated")
                       for e, (_, f) in zip(edits, rows)) + 2 * sum(gaps)
            if best is not None and (cost, audit) >= best:
                continue
            roles = [i for e, (i, _) in zip(edits, rows) if e == "K"]
            free = [e for e in audit if e != "D"]
            kept = iter(roles)
            wanted = [next(kept) if e == "K" else None for e in free]
            for choice in product("ua", repeat=wanted.count(None)):
                filled = iter(choice)
                if GRAMMAR.fullmatch("".join(w or next(filled) for w in wanted)):
                    best = (cost, audit)
                    break
    return best


def part_of(rows, whole=True):
    return C.parse_part([(i, {"s": "system", "u": "user", "a": "assistant"}.get(r, r), f)
                         for i, (r, f) in enumerate(rows)], whole)


def random_rows(rng, n):
    return [(rng.choice("suat"), rng.choice(["", "", "", "truncated", "blank", "duplicate"])) for _ in range(n)]


def test_least_cost_and_audit():
    rng = random.Random(3)
    for _ in range(60):
        rows = random_rows(rng, rng.randint(0, 4))
        assert part_of(rows).best() == brute_audit(rows), rows


def test_parts_in_any_cut_give_the_whole():
    rng = random.Random(4)
    for _ in range(40):
        rows = random_rows(rng, rng.randint(2, 300))
        whole = part_of(rows)
        cuts = sorted(rng.sample(range(1, len(rows)), min(len(rows) - 1, rng.randint(1, 5))))
        pieces = [part_of(rows[a:b], a == 0) for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        both = reduce(lambda x, y: x.before(y), pieces)
        assert both.best() == whole.best()
        assert [getattr(both, s) for s in ("n", "blank", "duplicate", "truncated", "illegal")] == [
            getattr(whole, s) for s in ("n", "blank", "duplicate", "truncated", "illegal")]


def test_a_long_run_of_equal_costs():
    """Audits that differ from their first letter on stay apart for ever."""
    assert part_of([("t", "")] * 1001).best() == (2 * 1000 + 3, "D" + "R" * 1000)
    assert part_of([("t", "")] * 1000).best() == (2 * 1000, "R" * 1000)


def test_the_repaired_roles_fit_the_grammar():
    rng = random.Random(6)
    for _ in range(200):
        rows = random_rows(rng, rng.randint(0, 12))
        names = [({"s": "system", "u": "user", "a": "assistant"}.get(r, r), "x") for r, _ in rows]
        out = list(C.apply_audit(part_of(rows).best()[1], iter(names)))
        assert GRAMMAR.fullmatch("".join(role[0] for _, role, _ in out))


def plain(rows):
    """What the query returns, by the contract, for rows (conv, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, kept in convs.items():
        def key(r):
            whole = f"{'-' if conv is None else conv}:{len(r[1].encode())}:{r[1]}{r[2]}"
            return r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(whole.encode()).digest()
        kept.sort(key=key)
        seen, faults = set(), []
        for _, role, text in kept:
            end = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen
                          else "truncated" if end[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[0] for r in kept if r[0] is not None]
        initials = [r[1][:1] for r in kept]
        cost, audit = C.parse_part([(r[0], r[1], f) for r, f in zip(kept, faults)], True).best()
        lines = [f"{role}:{text}" for _, role, text in C.apply_audit(audit, iter([r[1:] for r in kept]))]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                     *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


ODD = [
    (1, 0, "system", "Be brief."), (1, 1, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello!"),
    (2, None, None, None), (2, None, "", ""), (2, 5, "tool", "no end"), (None, 0, "user", "no id?"), (None, None, "user", "no id?"),
    (3, -4, "assistant", "starts\x0b wrong. \n"), (3, 900, "user", "é…"), (4, 1, "user", "word " * 60_000 + "end."),
    (4, 2, "assistant", "."), (5, 7, "user", " \t"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 7) for r in rows], SCHEMA)


def query(spark, monkeypatch, rows):
    monkeypatch.setattr(C, "read_table", lambda *a: frame(spark, rows))
    return {r[0]: tuple(r)[1:] for r in C.op13_conversation_repair(spark, "").collect()}


def test_odd_rows(spark, monkeypatch):
    assert query(spark, monkeypatch, ODD) == plain(ODD)


def test_one_conversation_and_one_text_in_most_rows(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(1, i, rng.choice(["user", "assistant", "assistant", "user", "system"]),
             rng.choice(["same.", f"text {i}.", "same.", f"no end {i}"])) for i in range(3000)]
    rows += [(1, 77, "user", "equal rows.")] * 700 + [(i, 0, "user", "x.") for i in range(2, 300)]
    assert query(spark, monkeypatch, rows) == plain(rows)


def test_empty_table(spark, monkeypatch):
    assert query(spark, monkeypatch, []) == {}
    assert C.repaired_turns(frame(spark, [])).collect() == []


def test_all_rows_dropped(spark, monkeypatch):
    dropped = next((9, t, "user", "x") for t in range(999) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    got = query(spark, monkeypatch, [dropped])
    assert got == {9: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


@pytest.mark.parametrize("rows,want", [
    ([(1, 0, "user", "a."), (1, 1, "assistant", "b.")], [("K", "user", "a."), ("K", "assistant", "b.")]),
    ([(1, 0, "user", "a."), (1, 1, "user", "b.")], [("K", "user", "a."), ("R", "assistant", "b.")]),
    ([(1, 0, "assistant", "b.")], [("I", "user", ""), ("K", "assistant", "b.")]),
])
def test_repaired_rows(spark, rows, want):
    got = C.repaired_turns(frame(spark, rows)).orderBy("pos").collect()
    assert [tuple(r)[2:] for r in got] == want and [r["pos"] for r in got] == list(range(len(want)))
    assert C.repair_report(frame(spark, rows), F.lit(False)).count() == 1
