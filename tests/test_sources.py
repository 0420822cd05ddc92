"""A1-A3 JSONL sources, sample ids, C2 with tools, K4 stream parity."""

import json
import os

from pyspark.sql import functions as F

from tokenloom.functions.chat import render_chat
from tokenloom.operators.encode import encode_dpo, encode_pretrain, encode_sft
from tokenloom.sources import jsonl as J
from tokenloom.streaming.encode_stream import start_append, stream_files


def _write(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        for x in lines:
            f.write((x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)) + "\n")


def test_pretrain_jsonl_ids_and_corrupt(spark, tmp_path):
    p = tmp_path / "pre.jsonl"
    _write(p, [{"text": "same"}, {"text": "same"}, {"text": "other"}, "{not json", {"text": None}])
    df = J.read_pretrain(spark, str(p))
    bad = df.where(F.col("_corrupt_record").isNotNull()).select("text", "_corrupt_record").collect()
    assert len(bad) == 1 and bad[0].text is None
    ided = J.with_sample_id(df.where(F.col("_corrupt_record").isNull()), "text")
    rows = ided.collect()
    assert len({r.sample_id for r in rows}) == 4
    again = {r.sample_id for r in J.with_sample_id(J.read_pretrain(spark, str(p))
                                                    .where(F.col("_corrupt_record").isNull()), "text").collect()}
    assert again == {r.sample_id for r in rows}
    enc = encode_pretrain(ided, max_length=8).collect()
    assert all(len(r.input_ids) == 8 for r in enc)


def test_sft_jsonl_tools_and_function_wrapper(spark, tmp_path):
    p = tmp_path / "sft.jsonl"
    rec = {"conversations": [
        {"role": "system", "content": "S", "functions": ['{"name": "f"}']},
        {"role": "user", "content": "q"},
        {"role": "assistant", "content": "", "tool_calls": [{"function": {"name": "f", "arguments": "{}"}}]},
        {"role": "tool", "content": "r"},
        {"role": "assistant", "content": "ok"}]}
    _write(p, [rec])
    df = J.read_sft(spark, str(p))
    r = df.select("tools", render_chat(F.col("messages"), F.col("tools")).alias("s")).first()
    assert r.tools == ['{"name": "f"}']
    assert '<tool_call>\n{"name": "f", "arguments": {}}\n</tool_call><|im_end|>' in r.s
    assert r.s.startswith("<|im_start|>system\nS\n\n# Tools")
    out = encode_sft(J.with_sample_id(df, "messages"), max_length=600).first()
    sup = bytes(t - 3 for t in out.labels if t not in (-100, 0, 1, 2)).decode()
    assert "ok" in sup and "<tool_call>" in sup and "q" not in sup.replace("<tool_call>", "")


def test_dpo_jsonl(spark, tmp_path):
    p = tmp_path / "dpo.jsonl"
    _write(p, [{"chosen": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "good"}],
                "rejected": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "bad"}]}])
    df = J.with_sample_id(J.read_dpo(spark, str(p)), "chosen", "rejected").withColumnRenamed("sample_id", "pair_id")
    r = encode_dpo(df, max_length=128).first()
    assert len(r.x_chosen) == 127 and sum(r.mask_chosen) == len("good") + 2
    assert sum(r.mask_rejected) == len("bad") + 2


def test_stream_parity(spark, tmp_path):
    src = tmp_path / "in"
    os.makedirs(src)
    texts = [f"doc {i} " + "é" * i for i in range(30)]
    for k in range(3):
        _write(src / f"part{k}.jsonl", [{"id": i, "text": texts[i]} for i in range(k * 10, k * 10 + 10)])
    schema = "id LONG, text STRING"
    stream = stream_files(spark, str(src), schema, fmt="json", max_files_per_trigger=1)
    q = start_append(encode_pretrain(stream, id_col="id", max_length=24),
                     str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination()
    got = sorted((r.id, list(r.input_ids)) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    batch = encode_pretrain(spark.read.schema(schema).json(str(src)), id_col="id", max_length=24)
    exp = sorted((r.id, list(r.input_ids)) for r in batch.collect())
    assert got == exp and len(got) == 30


def test_sft_stream_parity(spark, tmp_path):
    from tokenloom.streaming.encode_stream import stream_chat_records
    src = tmp_path / "chat"
    os.makedirs(src)
    for k in range(2):
        _write(src / f"c{k}.jsonl", [
            {"id": k * 10 + i, "conversations": [
                {"role": "system", "content": "S", "functions": ['{"name": "f"}'] if i % 2 else None},
                {"role": "user", "content": f"q{i}"},
                {"role": "assistant", "content": "", "tool_calls": [{"name": "f", "arguments": "{}"}]},
                {"role": "tool", "content": "r"},
                {"role": "assistant", "content": "a" * i}]} for i in range(5)])
    stream = stream_chat_records(spark, str(src), max_files_per_trigger=1)
    q = start_append(encode_sft(stream, id_col="id", max_length=200), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    got = sorted((r.id, list(r.input_ids), list(r.labels)) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    batch = J.sft_records(spark.read.schema("id LONG, " + J.SFT_SCHEMA).json(str(src)), keep=("id",))
    exp = sorted((r.id, list(r.input_ids), list(r.labels)) for r in encode_sft(batch, id_col="id", max_length=200).collect())
    assert got == exp and len(got) == 10


def test_hot_copies_numbered_across_splits(spark, tmp_path):
    src = tmp_path / "many"
    os.makedirs(src)
    for k in range(4):  # one text copied 60 times in every file
        _write(src / f"p{k}.jsonl", [{"text": "hot"}] * 60 + [{"text": f"cold {k} {i}"} for i in range(5)])
    df = J.read_pretrain(spark, str(src))
    ids = [r.sample_id for r in J.with_sample_id(df.where(F.col("_corrupt_record").isNull()), "text").collect()]
    assert len(ids) == 260 and len(set(ids)) == 260
    again = {r.sample_id for r in J.with_sample_id(J.read_pretrain(spark, str(src))
                                                    .where(F.col("_corrupt_record").isNull()), "text").collect()}
    assert again == set(ids)


def test_content_that_is_no_string_is_blank(spark, tmp_path):
    p = tmp_path / "c.jsonl"
    _write(p, [{"conversations": [{"role": "user", "content": c}]} for c in (42, ["a"], {"k": 1}, None, True, "42")])
    got = sorted(r.c or "" for r in J.checked(J.read_sft(spark, str(p))).select(F.col("messages")[0]["content"].alias("c")).collect())
    assert got == ["", "", "", "", "", "42"]


def test_preference_tool_calls_are_rendered(spark, tmp_path):
    p = tmp_path / "d.jsonl"
    call = {"role": "assistant", "content": "", "tool_calls": [{"function": {"name": "f", "arguments": "{}"}}]}
    _write(p, [{"chosen": [{"role": "user", "content": "q"}, call], "rejected": [{"role": "user", "content": "q"}]}])
    text = J.checked(J.read_dpo(spark, str(p))).select(render_chat(F.col("chosen")).alias("t")).first().t
    assert "<tool_call>" in text and "f" in text


def test_malformed_lines_fail_or_are_kept_aside(spark, tmp_path):
    import pytest
    p = tmp_path / "m.jsonl"
    _write(p, [{"text": "a"}, "{broken", {"text": "b"}])
    with pytest.raises(Exception, match="malformed record"):
        J.checked(J.read_pretrain(spark, str(p))).collect()
    left = J.checked(J.read_pretrain(spark, str(p)), rejects=str(tmp_path / "rejects"))
    assert sorted(r.text for r in left.collect()) == ["a", "b"]
    assert [r.value for r in spark.read.text(str(tmp_path / "rejects")).collect()] == ["{broken"]


def test_malformed_record_stops_the_stream(spark, tmp_path):
    import pytest
    from tokenloom.streaming.encode_stream import stream_chat_records
    src = tmp_path / "in"
    src.mkdir()
    _write(src / "a.jsonl", [{"id": 1, "conversations": [{"role": "user", "content": "q"}]}, "{broken"])
    q = start_append(stream_chat_records(spark, str(src)).select("id"), str(tmp_path / "out"), str(tmp_path / "ck"))
    with pytest.raises(Exception, match="malformed record"):
        q.awaitTermination()


def _ids(df):
    return sorted(r.sample_id for r in df.collect())


def test_ids_by_digest_leave_content_in_place(spark, tmp_path, monkeypatch):
    src = tmp_path / "lone.jsonl"
    _write(src, [{"text": f"text {i}"} for i in range(50)] + [{"text": None}, {"text": ""}])
    df = J.checked(J.read_pretrain(spark, str(src)))
    out = J.with_sample_id(df, "text")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert len(set(_ids(out))) == 52 and all(i.endswith("-0") for i in _ids(out))
    _write(src, [{"text": f"text {i}"} for i in range(50)] + [{"text": "twice"}] * 2 + [{"text": None}] * 3)
    df = J.checked(J.read_pretrain(spark, str(src)))
    out = J.with_sample_id(df, "text")
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    lone = plan[plan.index("Union"):plan.index("BroadcastExchange")]
    assert "LeftAnti" in lone and "Exchange" not in lone  # lone records stay where they are
    want = _ids(out)
    assert len(set(want)) == 55 and sum(i.endswith("-1") for i in want) == 2 and sum(i.endswith("-2") for i in want) == 1
    monkeypatch.setattr(J, "MAX_BROADCAST_DIGESTS", 0)
    assert _ids(J.with_sample_id(df, "text")) == want
    monkeypatch.setattr(J, "COPIES_A_PIECE", 2)
    assert _ids(J.with_sample_id(df, "text")) == want
    # columns of their own: copies are numbered one by one, and keep them
    own = J.with_sample_id(df.withColumn("at", F.monotonically_increasing_id()), "text")
    assert _ids(own) == want and own.select("at").distinct().count() == 55


def test_copies_keep_their_content(spark, tmp_path):
    src = tmp_path / "chat.jsonl"
    turn = {"role": "user", "content": "hi"}
    _write(src, [{"conversations": [turn]}] * 3 + [{"conversations": [turn, turn]}])
    back = J.with_sample_id(J.checked(J.read_sft(spark, str(src))), "messages", "tools")
    rows = back.select("sample_id", F.size("messages").alias("n")).collect()
    assert sorted(r.n for r in rows) == [1, 1, 1, 2] and len({r.sample_id for r in rows}) == 4


def test_stream_of_a_table_in_one_file_or_many(spark, tmp_path):
    from tokenloom import queries as Q
    docs = spark.createDataFrame([(i, f"doc {i} " + "é" * i) for i in range(20)] + [(None, None)], "doc_id long, text string")
    base, single = tmp_path / "many", tmp_path / "one"
    docs.repartition(5).write.parquet(str(base / "documents.parquet"))
    docs.coalesce(1).write.parquet(str(tmp_path / "part"))
    os.makedirs(single)
    next((tmp_path / "part").glob("part-*")).rename(single / "documents.parquet")
    exp = sorted(map(str, Q.pretrain_encode(spark, str(base)).collect()))
    assert len(exp) == 21
    for place in (base, single):
        assert sorted(map(str, Q.stream_encode(spark, str(place)).collect())) == exp
