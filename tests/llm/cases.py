"""Small tables shared by the operators' tests."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()),
                     T.StructField("run", T.IntegerType()), T.StructField("node", T.StringType())])

LONG = " ".join(f"w{i % 977} Über{i % 31}" for i in range(30_000))
PROSE = "The quick brown fox jumps over the lazy dog while seven wizards watch from the old tower"

ROWS = [
    (5, PROSE, 1), (3, PROSE, 1), (3, PROSE, 1),  # equal texts, a repeated row
    (9, PROSE.replace("seven", "eight"), 2), (12, LONG, 3), (7, "", 4), (8, None, 5),
    (None, "a lone text without an id", 6), (21, "one", 7), (22, "ONE", 7), (23, " \t\n ", 8),
    (24, "é ü  ñ\n\nß 漢字 <|endoftext|> don't 12,5", 9), (-4, "negative ids sort first", 10),
]


def docs_frame(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "en", None, len(t or ""), "clash", k, "x") for i, t, k in rows], DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def by_key(rows, *keys):
    return sorted((tuple(r[k] for k in keys) for r in rows), key=str)
