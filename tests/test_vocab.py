"""B2 plug point: a Python tokenizer through Arrow batches gives the same
samples as the native byte tokenizer."""


from conftest import SF001
from tokenloom.operators import conversations as conv
from tokenloom.operators.encode import encode_dpo, encode_pretrain, encode_sft
from tokenloom.operators.vocab import ByteTokenizer
from tokenloom.sources import tables as T


def _rows(df, key):
    return sorted(tuple(list(v) if isinstance(v, list) else v for v in r) for r in df.orderBy(key).collect())


def test_plug_equals_native_pretrain(spark):
    recs = T.pretrain_records(spark, SF001)
    a = encode_pretrain(recs, max_length=64)
    b = encode_pretrain(recs, max_length=64, tokenizer_factory=ByteTokenizer)
    assert _rows(a, "sample_id") == _rows(b, "sample_id")


def test_plug_equals_native_sft_and_dpo(spark):
    turns = T.turns(spark, SF001)
    recs = conv.chat_records(turns)
    a = encode_sft(recs, id_col="conv_id", tools_col=None, max_length=300)
    b = encode_sft(recs, id_col="conv_id", tools_col=None, max_length=300, tokenizer_factory=ByteTokenizer)
    assert _rows(a, "conv_id") == _rows(b, "conv_id")
    pairs = conv.preference_pairs(turns)
    c = encode_dpo(pairs, max_length=200)
    d = encode_dpo(pairs, max_length=200, tokenizer_factory=ByteTokenizer)
    assert _rows(c, "pair_id") == _rows(d, "pair_id")


def test_budget_holds_for_a_word_vocabulary(spark):
    class WordTokenizer:
        """Few ids a message: one for each marker line, word and gap."""

        def encode_batch(self, texts):
            import re
            parts = re.compile(r"<\|im_start\|>\w+\n|<\|im_end\|>\n|\S+|\s+")
            return [[sum(p.encode()) % 5000 + 3 for p in parts.findall(t)] for t in texts]

    turns = spark.createDataFrame([(1, i, "user" if i % 2 == 0 else "assistant", "w") for i in range(60)],
                                  "conv_id long, turn long, role string, content string")
    whole = encode_sft(conv.chat_records(turns), id_col="conv_id", tools_col=None, max_length=96,
                       tokenizer_factory=WordTokenizer)
    cut = encode_sft(conv.chat_records(turns, max_tokens=96), id_col="conv_id", tools_col=None, max_length=96,
                     tokenizer_factory=WordTokenizer)
    assert _rows(whole, "conv_id") == _rows(cut, "conv_id")


def test_public_vocabulary_equals_the_library_at_all_lengths(spark):
    import pytest
    pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from tokenloom.operators.vocab import HFTokenizer, detokenize_column, tokenize_column
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public.path(name)
        own = Tokenizer.from_file(path)
        texts = [None, "", " ", "x", "é漢😀\n\t", "don't  stop", *["word " * n for n in (1, 7, 300, 9000)]]
        df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
        for most in (None, 1, 5, 400):
            got = tokenize_column(df, "t", lambda: HFTokenizer(path), "ids", most)
            back = detokenize_column(got, "ids", lambda: HFTokenizer(path), "back").collect()
            for r in back:
                ids = own.encode(texts[r.k] or "", add_special_tokens=False).ids[:most]
                assert r.ids == ids and r.back == own.decode(ids, skip_special_tokens=True)


def test_replies_in_the_users_vocabulary(spark):
    from tokenloom.operators import prompts as PR
    from tokenloom.operators.vocab import tokenize_column
    df = spark.createDataFrame([(1, "héllo"), (2, ""), (3, None)], "k int, t string")
    prompts = tokenize_column(df, "t", ByteTokenizer, "prompt_ids")
    out = PR.decode_replies(PR.generate(prompts, PR.repeat_predictor_factory), ByteTokenizer)
    assert {r.k: r.reply for r in out.collect()} == {1: "héllo", 2: "", 3: ""}


def test_python_steps_get_bounded_slices(spark):
    from pyspark.sql import functions as F

    from tokenloom.functions.util import SLICE_SIZE
    from tokenloom.operators import prompts as PR
    from tokenloom.operators.vocab import detokenize_column, tokenize_column

    class Watched(ByteTokenizer):
        """Fails if it gets more than a slice at a time, but for one row."""

        def encode_batch(self, texts):
            assert len(texts) == 1 or sum(len(t.encode()) for t in texts) <= SLICE_SIZE
            return super().encode_batch(texts)

        def decode_batch(self, ids):
            assert len(ids) == 1 or sum(map(len, ids)) <= SLICE_SIZE
            return super().decode_batch(ids)

    def watched_predictor():
        def predict(batch):
            assert len(batch) == 1 or sum(map(len, batch)) <= SLICE_SIZE
            return [[*x, 4] for x in batch]
        return predict

    most = SLICE_SIZE
    n = F.when(F.col("k") == 5, most + 10).when(F.col("k") == 9, most).when(F.col("k") % 7 == 3, 0).otherwise(900)
    df = (spark.range(1000).coalesce(1).withColumnRenamed("id", "k")
          .withColumn("t", F.when(F.col("k") % 50 != 20, F.repeat(F.lit("x"), n.cast("int")))))
    out = PR.generate(tokenize_column(df, "t", Watched, "prompt_ids"), watched_predictor)
    rows = detokenize_column(out, "output_ids", Watched, "back").select(
        "k", F.size("prompt_ids").alias("n"), F.col("back") == F.concat(F.coalesce("t", F.lit("")), F.lit("\x01")),
        F.coalesce(F.length("t"), F.lit(0)).alias("m")).collect()
    assert [r.k for r in rows] == list(range(1000)) and all(r[2] and r.n == r.m for r in rows)
    assert tokenize_column(df.where("k < 0"), "t", Watched).count() == 0
