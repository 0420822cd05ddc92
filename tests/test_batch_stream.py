"""K4 + A7: rejected lines, progress and replays of a stream."""

import json

from pyspark.sql import functions as F

from tokenloom.operators.logs import latest_progress
from tokenloom.streaming import batch_stream as BS
from tokenloom.streaming.encode_stream import stream_files

SCHEMA = f"id LONG, text STRING, {BS.CORRUPT} STRING"


def _write(path, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write("".join(r if isinstance(r, str) else json.dumps(r) + "\n" for r in rows))


def _encode(df):
    return df.select("id", F.length("text").alias("n"))


def _state(spark, home):
    return (sorted(map(tuple, BS.finished(spark, home).collect()), key=str),
            sorted(map(tuple, BS.finished(spark, home, "rejects").collect()), key=str),
            sorted(map(tuple, BS.progress(spark, home).collect())))


def test_rejects_progress_and_restart(spark, tmp_path):
    src, home, ck = tmp_path / "in", str(tmp_path / "home"), str(tmp_path / "ck")
    src.mkdir()
    _write(src / "a.json", [{"id": 1, "text": "one"}, '{"id": 2, "tex\n', {"id": 3, "text": "three"}])
    _write(src / "b.json", [{"id": 4, "text": "four"}, "not json\n", '{"id": "x"}\n'])

    def run():
        BS.start_batches(stream_files(spark, str(src), SCHEMA, max_files_per_trigger=1), home, ck, _encode).awaitTermination()

    run()
    samples, rejects, progress = _state(spark, home)
    assert sorted(s[0] for s in samples) == [1, 3, 4]
    assert sorted(r[0] for r in rejects) == sorted(['{"id": 2, "tex', 'not json', '{"id": "x"}'])
    assert sorted((p[2], p[3], p[4]) for p in progress) in ([(0, 1, 2), (1, 2, 1)], [(0, 2, 1), (1, 1, 2)])
    _write(src / "c.json", [{"id": 5, "text": "five"}])
    run()  # goes on behind the last batch
    assert sorted(s[0] for s in BS.finished(spark, home).collect()) == [1, 3, 4, 5]
    assert latest_progress(BS.progress(spark, home)).first().step == 2


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    home = str(tmp_path / "home")
    _write(tmp_path / "x.json", [{"id": 1, "text": "one"}, "broken\n"])
    df = spark.read.schema(SCHEMA).json(str(tmp_path / "x.json"))
    for k in (0, 1):
        BS.write_batch(df, k, home, _encode)
    before = _state(spark, home)
    BS.write_batch(df, 0, home, _encode)
    assert _state(spark, home) == before and len(before[0]) == 2


def test_an_unfinished_batch_is_not_read(spark, tmp_path):
    home = str(tmp_path / "home")
    _write(tmp_path / "x.json", [{"id": 1, "text": "one"}])
    df = spark.read.schema(SCHEMA).json(str(tmp_path / "x.json"))
    BS.write_batch(df, 0, home, _encode)
    _encode(df).write.parquet(f"{home}/samples/batch=1")  # killed before its progress row
    assert [r.id for r in BS.finished(spark, home).collect()] == [1]
