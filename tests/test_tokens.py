"""B1-B9 and C1 on hand-made texts (FIXTURES.md part 3)."""

import random

from pyspark.sql import functions as F

from conftest import py_tokenize
from tokenloom.functions.tokens import encode_text, token_count
from tokenloom.operators.encode import encode_pretrain

L = 16


def _encode_rows(spark, texts, L=L):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "sample_id long, text string")
    rows = encode_pretrain(df, max_length=L).orderBy("sample_id").collect()
    return [(r.input_ids, r.labels) for r in rows]


def _expected(text, L=L):
    toks = py_tokenize("None" if text is None else text)[:L - 2]
    ids = [1] + toks + [2]
    ids += [0] * (L - len(ids))
    return ids, [-100 if t == 0 else t for t in ids]


def test_pretrain_hand_made_cases(spark):
    texts = [None, "", "a" * (L - 2), "b" * (L - 1), "é" * 10, "x<|endoftext|>y",
             "abcdefghijklm" + "日本", "<|im_start|>user\nhi<|im_end|>", "<|im_end|>" * 20]
    got = _encode_rows(spark, texts)
    for text, (ids, labels) in zip(texts, got):
        assert (list(ids), list(labels)) == _expected(text), text


def test_null_text_is_string_none(spark):
    (ids, _), = _encode_rows(spark, [None])
    assert list(ids[:6]) == [1] + [b + 3 for b in b"None"] + [2]


def test_literal_endoftext_masked_in_labels(spark):
    (ids, labels), = _encode_rows(spark, ["x<|endoftext|>y"])
    assert ids[2] == 0 and labels[2] == -100


def test_random_texts_match_reference(spark):
    rnd = random.Random(7)
    alphabet = ["a", "b", " ", "\n", "é", "日", "😀", "<", "|", ">", "<|im_end|>", "<|im_start|>",
                "<|endoftext|>", "<|im_", "|>"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    for k in (1, 5, 17, None):
        rows = df.select("i", encode_text(F.col("t"), k).alias("ids"),
                         token_count(F.col("t")).alias("n")).orderBy("i").collect()
        for t, r in zip(texts, rows):
            exp = py_tokenize(t)
            assert list(r.ids) == (exp if k is None else exp[:k]), (t, k)
            assert r.n == len(exp)


def test_prefix_cut_never_changes_ids(spark):
    # a special string starting exactly at the cut position must stay one id
    t = "a" * 9 + "<|im_end|>tail"
    df = spark.createDataFrame([(t,)], "t string")
    for k in range(1, 14):
        got = df.select(encode_text(F.col("t"), k).alias("x")).first().x
        assert list(got) == py_tokenize(t)[:k]
