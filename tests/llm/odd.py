"""Odd documents for the operators' tests, and brute-force helpers."""

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = re.compile(r"[\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Extra columns with names that the operators use inside.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("k", T.StringType()), T.StructField("h", T.StringType()),
    T.StructField("shard", T.StringType()), T.StructField("node", T.StringType()), T.StructField("toxic", T.StringType()),
    T.StructField("copies", T.StringType()), T.StructField("rid", T.StringType()), T.StructField("kept", T.StringType())])


def row(i, text, source="a"):
    return (i, text, source, "x", "x", "x", "x", "x", None, "x", "x")


def texts(seed=1):
    """(doc_id, text, source): nulls, empties, a very long text, repeated rows,
    ids used twice, exact and near copies, shared passages, odd white space."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 4)))
    body = lambda n: " ".join(word() for _ in range(n))
    one, passage, long_ = body(120), body(30), body(9000)
    near = one.split()
    near[60] = "changed"
    out = [(1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, one, "b"), (5, one.replace(" ", "  ", 9), "b"),
           (6, " ".join(near), "b"), (7, one, None), (7, one, None), (8, body(50), "c"), (8, body(40), "c"),
           (None, body(20), "c"), (None, one, "d"), (None, None, "d"), (9, long_, "d"), (10, long_[:-7], "e"),
           (11, body(10) + " " + passage + " " + body(10), "e"), (12, passage + " " + body(9), "e"),
           (13, body(3) + " " + passage, "f"), (14, "Ein Wort", "f"), (15, "ein wort", "f"), (16, "x", "g"), (17, "x", "g"),
           (18, "Ünï\x00cödé 😀 text　mit\xa0allem ▁ <s>", "g"), (19, "word " * 400, "é"), (20, "word " * 399, "Z")]
    return out + [(100 + i, body(r.randint(1, 60)), r.choice(["a", "b", None])) for i in range(25)]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([row(*x) for x in rows], SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
