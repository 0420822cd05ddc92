import random
import re

import pytest
from cases import LONG, by_key, docs_frame, empty_docs
from tokenloom.llm import license_templates as L

TEMPLATES = [
    ("plain", "alpha beta gamma"),
    ("optional", "alpha <<beginOptional>>beta <<beginOptional>>x y<<endOptional>><<endOptional>> gamma delta"),
    ("words", "gamma <<var;words=0-2>> delta"),
    ("match", "beta <<var;match=x y|gamma|>> alpha"),
]


def as_regex(wording: str) -> re.Pattern:
    """The template over text of words that are followed by one space each."""
    out = ""
    for piece in re.split(r"(<<[^>]*>>)", wording):
        if piece == "<<beginOptional>>":
            out += "(?:"
        elif piece == "<<endOptional>>":
            out += ")?"
        elif piece.startswith("<<var;words="):
            out += "(?:[a-z]+ ){%s,%s}" % tuple(piece[12:-2].split("-"))
        elif piece.startswith("<<var;match="):
            out += "(?:" + "|".join("".join(w + " " for w in x.split()) for x in piece[12:-2].split("|")) + ")"
        else:
            out += "".join(w + " " for w in piece.split())
    return re.compile(out)


def brute(words: list[str], wording: str) -> list[tuple[int, int]]:
    """(latest start, end) for each end of a match."""
    pattern, found = as_regex(wording), {}
    for i in range(len(words)):
        for j in range(i + 1, len(words) + 1):
            if pattern.fullmatch("".join(w + " " for w in words[i:j])):
                found[j - 1] = i
    return sorted((i, j) for j, i in found.items())


def test_automaton_against_regular_expressions():
    scanner, rng = L.Scanner({"x y": "base"}, TEMPLATES), random.Random(5)
    for _ in range(400):
        words = rng.choices(["alpha", "beta", "gamma", "delta", "x", "y", "other"], k=rng.randint(0, 14))
        got = scanner.scan(" ".join(words))
        for label, wording in TEMPLATES:
            assert sorted(p[1:] for p in got.places if p[0] == label) == brute(words, wording), (words, label)
        assert sorted(p[1:] for p in got.base) == brute(words, "x y")
        assert got.n_words == len(words)


@pytest.mark.parametrize("text,labels", [
    ("Licensed under the Apache License, Version 2.0.", {"apache-2.0"}),
    ("This file is distributed under the terms of the MIT license", {"mit"}),
    ("licensed under the GNU Lesser General Public License, version 2.1", {"lgpl-2.1"}),
    ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}),
    ("available under a Creative Commons Attribution-ShareAlike 3.0 International License", {"cc-by-sa-3.0"}),
    ("Neither the name of ACME Corp. nor the names of its contributors", set()),
    ("licensed under the apache licence version 2.0", set()),  # not its wording
    ("The Apache license is one, the MIT license is another", set()),
])
def test_notices(text, labels):
    found = L.Scanner().scan(text)
    assert {p[0] for p in found.places} == labels
    assert (found.score == 1) == bool(labels)


def test_replaceable_and_optional_regions_of_a_whole_licence():
    text = dict((k, w) for k, w in L.TEMPLATES if k == "bsd-3-clause" and "neither" in w)["bsd-3-clause"]
    wording = re.sub(r"<<beginOptional>>(.*?)<<endOptional>>", "", text)
    wording = wording.replace("<<var;words=1-20>>", "Some Org & Friends").replace("<<var;match=its|the|their>>", "its")
    assert {p[0] for p in L.Scanner().scan(wording).places} == {"bsd-3-clause"}
    assert not L.Scanner().scan(wording.replace("specific prior", "prior")).places
    assert 0.9 < L.Scanner().scan(wording.replace("specific prior", "prior")).score < 1


def test_states_are_made_anew(monkeypatch):
    monkeypatch.setattr(L, "MAX_MADE", 3)
    scanner = L.Scanner()
    for _ in range(3):
        assert [p[0] for p in scanner.scan("Released under the MIT License.").places] == ["mit"]


def test_wrong_markup():
    with pytest.raises(ValueError, match="isn't closed"):
        L.Scanner({}, [("x", "a <<beginOptional>> b")])


def test_odd_rows(spark, monkeypatch):
    rows = [(1, "MIT License, mit license", 1), (1, "MIT License, mit license", 1), (2, None, 2), (3, "", 3),
            (None, "Released under the MIT License.", 4), (4, LONG + " general public license", 5), (5, "...", 6)]
    got = by_key(L.scan_documents(docs_frame(spark, rows)).collect(), "doc_id", "n_words", "base", "score")
    assert len(got) == len(rows)
    by_id = {r[0]: r for r in got}
    assert [tuple(b) for b in by_id[1][2]] == [("mit", 0, 1), ("mit", 2, 3)] and by_id[1][3] == 0.5
    assert by_id[2][1:] == by_id[3][1:] == by_id[5][1:] == (0, [], 0.0)
    assert by_id[None][3] == 1.0 and by_id[4][2][0][1] == len(LONG.split())
    assert L.scan_documents(empty_docs(spark)).collect() == []
    monkeypatch.setattr(L, "read_table", lambda *a: docs_frame(spark, rows))
    query = {r["doc_id"]: r for r in L.op11_license_scan(spark, "").collect()}
    assert query[1][1:8] == (4, 2, 0, 2, "mit", "mit", 0.5)
    assert query[2][1:8] == (0, 0, None, None, "", "", 0.0)
