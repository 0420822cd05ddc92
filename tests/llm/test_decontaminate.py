import hashlib
import re

import pytest
from cases import ROWS, docs_frame, empty_docs
from tokenloom.llm import decontaminate as D

ITEMS = [(1, "the lazy dog while SEVEN wizards watch from the old tower, at night"), (2, "One"), (3, None), (4, "--"),
         (10, "w5 über5 w6 über6 w7 über7 w8 über8 w9 über9 w10 über10"), (11, "lone text"), (None, "an id")]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(text, size=10):
    w, hit, items = words(text), set(), set()
    for i, t in ITEMS:
        b = words(t)
        n = min(size, len(b))
        for s in range(len(b) - n + 1 if b else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == b[s:s + n]:
                    hit.update(range(p, p + n))
                    items.add(str(i))
    items.discard("None")
    return len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in df.collect()), key=str)


def test_against_brute_force(spark, items):
    want = sorted(((i, *brute(t)) for i, t, _ in ROWS), key=str)
    assert result(D.contamination_report(docs_frame(spark), items)) == want
    assert sum(r[2] > 0 for r in want) > 4


def test_without_the_literal_set(spark, items):
    rows = docs_frame(spark)
    small = D.scan_documents(rows, items)
    large = D.scan_documents(rows, items, max_set=3)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_documents_and_spans_are_removed(spark, items):
    rows = docs_frame(spark)
    left = D.drop_contaminated(rows, items)
    assert left.columns == rows.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i, t, _ in ROWS if not brute(t)[1])
    cut = D.remove_spans(rows, items)
    assert cut.columns == rows.columns and cut.count() == len(ROWS)
    assert result(D.contamination_report(cut, items.where("item_id = 1")))[0][2] == 0
    text = {r.doc_id: r.text for r in cut.collect()}
    assert text[5] == "The quick brown fox jumps over "
    assert text[8] is None and text[7] == "" and text[-4] == "negative ids sort first"


def test_empty_tables(spark, items):
    assert D.contamination_report(empty_docs(spark), items).count() == 0
    clean = D.contamination_report(docs_frame(spark), items.limit(0)).collect()
    assert len(clean) == len(ROWS) and not any(r.contaminated for r in clean)


def test_no_python_in_the_plan(spark, items):
    plan = D.contamination_report(docs_frame(spark), items)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct", plan)
