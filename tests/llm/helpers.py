"""Small documents that every text operator must handle: nulls, empty and long texts, ties, copies, odd columns."""

import random

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    T.StructField("size", T.LongType()), T.StructField("copies", T.StringType()), T.StructField("_gone", T.StringType()),
    T.StructField("_text", T.StringType()), T.StructField("sha", T.StringType()), T.StructField("label", T.DoubleType())])

WORDS = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "Lambda", "MU"]


def edge_rows() -> list[tuple]:
    rng = random.Random(3)
    long_ = " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(6000))
    near = long_.split(" ")
    near[17] = "changed"
    body = "\n".join(" ".join(rng.choice(WORDS) for _ in range(9)) for _ in range(12))
    texts = [None, "", " ", "one", "One", "one two", "!!! 123", long_, " ".join(near), body, body, "x\n" + body,
             "a" * 130, "b" + "a" * 130, "\0 zero \0\0", "ünïcödé ▁ text 😀 ퟿", "one", body + "\ntail line here", "日本語のテキスト",
             "same line\n" * 40]
    out = [(i, t, ["en", "de", None][i % 3], ["s0", "s1", None, "s0"][i % 4], None if t is None else len(t), i, "c", "g", "t",
            "h", 0.5) for i, t in enumerate(texts)]
    return [*out, (None, "one", None, None, None, None, None, None, None, None, None)]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text) -> list[bytes]:
    return (text or "").encode().lower().split()
