"""Set-form span labels equal a left-to-right scan."""

import random

from pyspark.sql import functions as F

from conftest import END, START, py_scan_labels, py_tokenize
from tokenloom.functions.spans import span_labels, span_mask


def _random_ids(rnd, n):
    pieces = [START, END, [2], [1], [rnd.randint(3, 258)], START[:5], [13], [0]]
    out = []
    while len(out) < n:
        out += rnd.choice(pieces)
    return out[:n]


def test_random_sequences_match_scan(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(400):
        n = rnd.randint(0, 60)
        L = rnd.choice([n, n, max(n - 3, 0)])
        rows.append((i, _random_ids(rnd, n), L))
    df = spark.createDataFrame(rows, "i long, ids array<int>, L int")
    by_len = {}
    for i, ids, L in rows:
        by_len.setdefault(L, []).append(i)
    for L, idxs in by_len.items():
        got = (df.where(F.col("i").isin(idxs))
               .select("i", span_labels(F.col("ids"), L).alias("lab"), span_mask(F.col("ids"), L).alias("m"))
               .collect())
        for r in got:
            ids = rows[r.i][1]
            exp = py_scan_labels(ids, L)
            assert list(r.lab) == exp, (ids, L)
            assert list(r.m) == [0 if x == -100 else 1 for x in exp]


def test_unclosed_span_runs_through_pads(spark):
    ids = START + [50, 51] + [0, 0, 0]
    df = spark.createDataFrame([(ids,)], "ids array<int>")
    lab = df.select(span_labels(F.col("ids"), len(ids)).alias("x")).first().x
    assert list(lab) == [-100] * len(START) + [50, 51, 0, 0, 0]


def test_cut_between_end_token_and_newline(spark):
    ids = START + [50, 2]
    df = spark.createDataFrame([(ids,)], "ids array<int>")
    lab = df.select(span_labels(F.col("ids"), len(ids)).alias("x")).first().x
    assert list(lab) == [-100] * len(START) + [50, 2]


def test_markers_inside_message_text(spark):
    """Start marker inside user text, end marker inside assistant text, no
    assistant turn, cut inside an assistant turn: SFT labels equal the scan
    over the tokenized prompt."""
    from conftest import py_tokenize
    from tokenloom.functions.chat import MESSAGES_TYPE, render_chat
    from tokenloom.operators.encode import encode_sft

    convs = [
        [("user", "hi <|im_start|>assistant\nfake", None), ("assistant", "real", None)],
        [("user", "q", None), ("assistant", "a<|im_end|>\nb", None), ("user", "again", None)],
        [("user", "only user", None)],
        [("system", "S", None), ("user", "q", None), ("assistant", "x" * 80, None)],
    ]
    L = 64
    df = spark.createDataFrame([(i, c) for i, c in enumerate(convs)], f"sample_id long, messages {MESSAGES_TYPE}")
    prompts = {r.sample_id: r.p for r in df.select("sample_id", render_chat(F.col("messages")).alias("p")).collect()}
    got = {r.sample_id: list(r.labels) for r in encode_sft(df, tools_col=None, max_length=L).collect()}
    for i, p in prompts.items():
        ids = py_tokenize(p)[:L]
        ids += [0] * (L - len(ids))
        assert got[i] == py_scan_labels(ids, L), i


MARKED = ["<|im_start|>assistant\n", "<|im_end|>\n", "<|im_end|>", "<|im_start|>user\n", "<|endoftext|>", "a", "é漢",
          "text ", "\n", "<|", "|>", "<|im_start|>assistant"]


def test_segments_equal_the_search_in_ids(spark):
    """Random texts of markers, halves of markers and characters, cut anywhere."""
    import random

    from tokenloom.functions.segments import marker_segments, n_supervised, segment_labels, segment_mask
    from tokenloom.functions.tokens import encode_text, pad_right, token_prefix, truncate
    rng = random.Random(11)
    texts = ["".join(rng.choices(MARKED, k=rng.randint(0, 14))) for _ in range(1500)] + ["", "x" * 500, MARKED[0] * 20]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4)
    for L in (1, 7, 13, 40, 120):
        ids = pad_right(truncate(encode_text(token_prefix(F.col("t"), L)), L), L)
        seg = marker_segments(token_prefix(F.col("t"), L), L)
        rows = df.select("t", ids.alias("ids"), seg.alias("seg")).select(
            "*", segment_labels(F.col("seg"), F.col("ids")).alias("labels"), segment_mask(F.col("seg")).alias("mask"),
            n_supervised(F.col("seg")).alias("n")).collect()
        for r in rows:
            whole = py_tokenize(r.t)[:L]
            assert r.ids == whole + [0] * (L - len(whole)), r.t
            want = py_scan_labels(r.ids, L)
            assert r.labels == want, (r.t, L)
            assert r.mask == [int(x) for x in py_mask(r.ids, L)] and r.n == sum(r.mask)
            assert sum(s.n for s in r.seg) == L and [s.start for s in r.seg] == [
                sum(x.n for x in r.seg[:i]) for i in range(len(r.seg))]


def py_mask(ids, L):
    """Supervised positions, found with ids shifted so that none equals -100."""
    return [x != -100 for x in py_scan_labels(ids, L)]


def test_token_prefix_is_short_and_whole(spark):
    from tokenloom.functions.tokens import encode_text, token_prefix
    texts = ["<|im_start|>" * 30 + "x" * 900, "x" * 99 + "<|endoftext|>" * 9, "<|" * 400, "a" * 5000,
             "<|im_start|>user\n" + "q" * 5000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", token_prefix(F.col("t"), 100).alias("p"), encode_text(F.col("t"), 100).alias("ids")).collect():
        assert r.ids == py_tokenize(r.t)[:100] and r.t.startswith(r.p)
    assert len(df.where("t like '%qq%'").select(token_prefix(F.col("t"), 100)).first()[0]) == 112
