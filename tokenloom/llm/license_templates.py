"""Licence wording in texts, found by templates with markup.

A template is its wording with two kinds of markup: an optional region,
``<<beginOptional>>...<<endOptional>>`` (nested ones too), and a replaceable
region, ``<<var;words=2-40>>`` (any words, so many) or ``<<var;match=a b|c>>``
(one of the listed wordings; an empty one stands for none). Templates are
compiled to one automaton over words. It is run once over every text, from
every word at once, and accepts where all mandatory wording stands, word for
word and in order. Its states are sets of template positions, made when first
met, so a text costs one look-up a word however many templates there are.

Words are compared after A-Z are lower-cased; all between them is ignored.
``base`` phrases are templates without markup, and each place of theirs counts.
A place of another template runs from the latest word from which the words up
to the accepted one are a whole match.

``score``: 1 if a licence template is accepted; else the greatest share of a
licence template's mandatory words, but the first, that a stretch of the text
matches from the template's start, at least 0.5 with a base phrase.

Cases: null and empty texts, and texts without words, have no labels and score
0; very long texts are read whole, in time in proportion to their words;
repeated rows and ids give a row each; an empty table gives no rows; other
columns, whatever their names, are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batched, read_table

# Phrases and labels of the contract.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

_GRANT = "<<var;match=licensed|released|distributed|available|provided|published|covered|use is permitted>>"
_UNDER = f"{_GRANT} under <<beginOptional>>the terms of<<endOptional>> <<beginOptional>>the<<endOptional>>"
_CC = f"{_UNDER} <<beginOptional>>a<<endOptional>> <<var;match=cc|creative commons>>"
_CC_END = "<<beginOptional>>international<<endOptional>>"
_GPL = ("<<beginOptional>>either<<endOptional>> <<var;match=version|v>> {0}"
        " <<beginOptional>>of the license<<endOptional>>")
_FREE = ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
         "{0}general public license as published by the free software foundation " + _GPL)
_BSD = ("redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met <<beginOptional>>1<<endOptional>> redistributions of source code must "
        "retain the above copyright notice this list of conditions and the following disclaimer "
        "<<beginOptional>>2<<endOptional>> redistributions in binary form must reproduce the above copyright notice "
        "this list of conditions and the following disclaimer in the documentation and or other materials provided "
        "with the distribution")

# Wording of public licences and of their usual notices.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction including "
            "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
            "of the software and to permit persons to whom the software is furnished to do so subject to the "
            "following conditions the above copyright notice and this permission notice "
            "<<beginOptional>>including the next paragraph<<endOptional>> shall be included in all copies or "
            "substantial portions of the software"),
    ("mit", f"{_UNDER} <<var;match=mit|expat|x11>> license"),
    ("isc", "permission to use copy modify and <<var;match=or|>> distribute this software for any purpose with or "
            "without fee is hereby granted provided that the above copyright notice and this permission notice appear "
            "in all copies"),
    ("isc", f"{_UNDER} isc license"),
    ("bsd-2-clause", f"{_BSD} this software is provided by <<var;words=1-20>> as is"),
    ("bsd-3-clause", f"{_BSD} <<beginOptional>>3<<endOptional>> neither the name of <<var;words=1-20>> nor the names "
                     "of <<var;match=its|the|their>> contributors may be used to endorse or promote products derived "
                     "from this software without specific prior written permission"),
    ("bsd-2-clause", f"{_UNDER} <<var;match=bsd 2 clause|simplified bsd|2 clause bsd>> license"),
    ("bsd-3-clause", f"{_UNDER} <<var;match=bsd 3 clause|new bsd|modified bsd|3 clause bsd>> license"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be "
             "held liable for any damages arising from the use of this software permission is granted to anyone to "
             "use this software for any purpose including commercial applications"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in "
                   "compliance with the license"),
    ("apache-2.0", f"{_UNDER} apache <<beginOptional>>software<<endOptional>> license <<var;match=version|v|>> 2 0"),
    ("apache-2.0", f"{_UNDER} apache <<var;match=2 0|2>> license"),
    ("gpl-2.0", _FREE.format("", 2)),
    ("gpl-3.0", _FREE.format("", 3)),
    ("lgpl-2.1", _FREE.format("lesser ", "2 1")),
    ("lgpl-3.0", _FREE.format("lesser ", 3)),
    ("agpl-3.0", _FREE.format("affero ", 3)),
    *[(f"{short}-{v.replace(' ', '.') if ' ' in v else v + '.0'}",
       f"{_UNDER} gnu {name}general public license " + _GPL.format(v))
      for short, name, v in (("gpl", "", "2"), ("gpl", "", "3"), ("lgpl", "lesser ", "2 1"), ("lgpl", "lesser ", "3"),
                             ("agpl", "affero ", "3"))],
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2.0", f"{_UNDER} mozilla public license <<var;match=version|v|>> 2 0"),
    ("cc0-1.0", f"{_CC} <<var;match=0|zero>> 1 0 universal"),
    ("cc0-1.0", f"{_UNDER} cc0 1 0"),
    *[(f"cc-{short}-{v}.0", f"{_CC} <<var;match={words}>> {v} 0 {_CC_END}") for v in ("3", "4") for short, words in (
        ("by", "by|attribution"), ("by-sa", "by sa|attribution sharealike|attribution share alike"),
        ("by-nc", "by nc|attribution noncommercial|attribution non commercial"),
        ("by-nd", "by nd|attribution noderivatives|attribution no derivatives"),
        ("by-nc-sa", "by nc sa|attribution noncommercial sharealike|attribution non commercial share alike"),
        ("by-nc-nd", "by nc nd|attribution noncommercial noderivatives|attribution non commercial no derivatives"))],
]

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MARK = re.compile(r"<<(beginOptional|endOptional|var;words=(\d+)-(\d+)|var;match=([^>]*))>>")
MAX_MADE = 200_000  # look-ups kept at once; they are made anew beyond it


def words_of(text: str | None) -> list[bytes]:
    """Words in UTF-8, A-Z lower-cased."""
    return _WORD.findall((text or "").encode("utf-8").lower())


@dataclass
class Automaton:
    """Positions of all templates: ``step[p]`` lists (word or None for any,
    next position), ``skip[p]`` the positions reached without a word."""

    templates: list[tuple[str, str]]
    step: list[list[tuple[bytes | None, int]]] = field(default_factory=list)
    skip: list[list[int]] = field(default_factory=list)
    starts: list[int] = field(default_factory=list)
    ends: dict[int, int] = field(default_factory=dict)  # position: template
    read: list[int] = field(default_factory=list)  # mandatory words before a position
    owner: list[int] = field(default_factory=list)

    def __post_init__(self) -> None:
        for t, (_, wording) in enumerate(self.templates):
            self._compile(t, wording)
        self.needed = {t: self.read[p] for p, t in self.ends.items()}
        back: list[list[tuple[bytes | None, int]]] = [[] for _ in self.step]
        back_skip: list[list[int]] = [[] for _ in self.step]
        for p, (steps, skips) in enumerate(zip(self.step, self.skip)):
            for w, q in steps:
                back[q].append((w, p))
            for q in skips:
                back_skip[q].append(p)
        self.back, self.back_skip = back, back_skip

    def _new(self, t: int, read: int) -> int:
        self.step.append([])
        self.skip.append([])
        self.owner.append(t)
        self.read.append(read)
        return len(self.step) - 1

    def _wording(self, t: int, at: int, words: Iterable[bytes], mandatory: bool) -> int:
        for w in words:
            to = self._new(t, self.read[at] + mandatory)
            self.step[at].append((w, to))
            at = to
        return at

    def _compile(self, t: int, wording: str) -> None:
        at = self._new(t, 0)
        self.starts.append(at)
        opened: list[int] = []
        done = 0
        for m in [*_MARK.finditer(wording), None]:
            at = self._wording(t, at, words_of(wording[done:m.start() if m else None]), not opened)
            if m is None:
                break
            done = m.end()
            if m[1] == "beginOptional":
                opened.append(at)
                at = self._join(t, [at])
            elif m[1] == "endOptional":
                at = self._join(t, [opened.pop(), at])
            elif m[2] is not None:
                least, most = int(m[2]), int(m[3])
                ends = [at] if least == 0 else []
                for i in range(1, most + 1):
                    to = self._new(t, self.read[at])
                    self.step[at].append((None, to))
                    at = to
                    ends += [at] if i >= least else []
                at = self._join(t, ends)
            else:
                at = self._join(t, [self._wording(t, at, words_of(x), False) for x in m[4].split("|")])
        if opened:
            raise ValueError(f"an optional region isn't closed: {wording}")
        self.ends[at] = t

    def _join(self, t: int, ends: list[int]) -> int:
        to = self._new(t, min(self.read[p] for p in ends))
        for p in ends:
            self.skip[p].append(to)
        return to

    @staticmethod
    def closure(positions: Iterable[int], skip: list[list[int]]) -> frozenset[int]:
        found, left = set(), list(positions)
        while left:
            p = left.pop()
            if p not in found:
                found.add(p)
                left += skip[p]
        return frozenset(found)

    def first_word(self, words: list[bytes], end: int, template: int) -> int:
        """Latest word from which ``words[:end]`` ends with a whole match."""
        at = self.closure([p for p, t in self.ends.items() if t == template], self.back_skip)
        start = self.starts[template]
        for i in range(end - 1, -1, -1):
            at = self.closure({q for p in at for w, q in self.back[p] if w is None or w == words[i]}, self.back_skip)
            if start in at:
                return i
        raise AssertionError("the automaton accepted no match")


class Matcher:
    """The automaton run by states that are made when first met."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.nfa = Automaton(templates)
        self.vocabulary = {w for steps in self.nfa.step for w, _ in steps if w is not None}
        self._reset()

    def _reset(self) -> None:
        self.number: dict[frozenset[int], int] = {}
        self.sets: list[frozenset[int]] = []
        self.moves: list[dict[bytes, int]] = []  # known words
        self.others: list[int] = []  # move by any other word; -1: not made yet
        self.accepts: list[list[int]] = []
        self.shares: list[dict[int, int]] = []  # template: mandatory words read
        self.made = 0
        self._state(self.nfa.closure(self.nfa.starts, self.nfa.skip))

    def _state(self, positions: frozenset[int]) -> int:
        if positions not in self.number:
            nfa, read = self.nfa, {}
            for p in positions:
                read[nfa.owner[p]] = max(read.get(nfa.owner[p], 0), nfa.read[p])
            self.number[positions] = len(self.sets)
            self.sets.append(positions)
            self.moves.append({})
            self.others.append(-1)
            self.accepts.append(sorted({nfa.ends[p] for p in positions if p in nfa.ends}))
            self.shares.append({t: n for t, n in read.items() if n > 1})
        return self.number[positions]

    def _make(self, state: int, word: bytes | None) -> int:
        self.made += 1
        nfa = self.nfa
        to = {q for p in self.sets[state] for w, q in nfa.step[p] if w is None or w == word}
        return self._state(nfa.closure([*to, *nfa.starts], nfa.skip))

    def run(self, words: list[bytes]) -> tuple[list[tuple[int, int]], dict[int, int]]:
        """[(template, words up to its end)] of all accepted places, and the
        most mandatory words read of each template, where more than one."""
        if self.made > MAX_MADE:
            self._reset()
        found, best, state = [], {}, 0
        known, moves, others, accepts, shares = self.vocabulary, self.moves, self.others, self.accepts, self.shares
        for i, w in enumerate(words, 1):
            if w in known:
                to = moves[state].get(w)
                if to is None:
                    to = moves[state][w] = self._make(state, w)
            else:
                to = others[state]
                if to < 0:
                    to = others[state] = self._make(state, None)
            state = to
            if shares[state]:
                for t, n in shares[state].items():
                    if n > best.get(t, 0):
                        best[t] = n
            if accepts[state]:
                found += [(t, i) for t in accepts[state]]
        return found, best


@dataclass(frozen=True)
class Found:
    """What a text holds: places are (label, first word, last word)."""

    n_words: int
    base: list[tuple[str, int, int]]
    places: list[tuple[str, int, int]]
    score: float


class Scanner:
    """``base`` phrases and licence templates, compiled together."""

    def __init__(self, base: dict[str, str] = BASE, templates: list[tuple[str, str]] = TEMPLATES):
        self.n_base = len(base)
        self.matcher = Matcher([(label, phrase) for phrase, label in base.items()] + list(templates))

    def scan(self, text: str | None) -> Found:
        words = words_of(text)
        accepted, read = self.matcher.run(words)
        nfa = self.matcher.nfa
        base, places = [], []
        for t, end in accepted:
            place = (nfa.templates[t][0], nfa.first_word(words, end, t), end - 1)
            (base if t < self.n_base else places).append(place)
        shares = [(n - 1) / (nfa.needed[t] - 1) for t, n in read.items() if t >= self.n_base and nfa.needed[t] > 1]
        score = 1.0 if places else max([0.5] * bool(base) + shares, default=0.0)
        return Found(len(words), base, places, score)


@lru_cache(maxsize=8)
def _scanner(base: tuple[tuple[str, str], ...], templates: tuple[tuple[str, str], ...]) -> Scanner:
    return Scanner(dict(base), list(templates))


_PLACES = "array<struct<label:string,first:bigint,last:bigint>>"


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] = BASE,
                   templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, base, places, score) of every row; ``base`` and
    ``places`` list (label, first, last), in words from 0."""
    fixed = tuple(base.items()), tuple(templates)
    _scanner(*fixed)  # templates with wrong markup fail here
    place = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))
    out = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("base", place), ("places", place),
                     ("score", pa.float64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        scanner = _scanner(*fixed)  # one a Python worker
        for b in batches:
            ids = b.column(0).to_pylist()
            for i, text in zip(ids, b.column(1)):
                f = scanner.scan(text.as_py())
                yield (i, f.n_words, *[[dict(zip(("label", "first", "last"), p)) for p in ps]
                                       for ps in (f.base, f.places)], f.score)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in batched(rows(batches), lambda r: 100 + 60 * (len(r[2]) + len(r[3])), 4 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*group), out)], schema=out)

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"doc_id long, n_words long, base {_PLACES}, places {_PLACES}, score double"))


def op11_license_scan(spark, sf_dir: str) -> DataFrame:
    found = scan_documents(read_table(spark, sf_dir, "documents"))
    labels = F.array_join(F.array_sort(F.array_distinct(F.concat("base.label", "places.label"))), ",")
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min("base.first").alias("first_word"),
        F.array_max("base.first").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
        labels.alias("labels"), "score", "places")
