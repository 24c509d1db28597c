"""Small tables with the cases that every operator must handle."""

import random

from pyspark.sql import functions as F

#: Names that the operators use inside; an input may have columns of these names.
CLASHING = ["key", "seg", "doc", "th", "id", "runs", "hub", "token", "cid", "n", "w", "rep", "score", "hits", "label", "row", "spans", "base",
            "n_words", "n_tokens", "_text", "_t", "_k0", "_word", "_mask", "bytes", "digest", "ref", "hot", "copies", "held", "place"]
SCHEMA = "doc_id long, text string"


def prose(seed, n, words=400):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(words)]
    return [r.choice(vocabulary) for _ in range(n)]


def with_extras(df):
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING if c not in df.columns])


def odd_rows(passage):
    """Nulls in every column, empty and blank texts, ties, repeated rows and ids, a very long text, other scripts."""
    long_text = " ".join(prose(9, 30_000)) + " " + passage
    return [
        (1, passage), (2, passage), (2, passage), (3, None), (4, ""), (5, " \n\t "), (6, "one"), (None, passage), (None, None),
        (7, long_text), (8, "Ünïcödé 日本語 \U0001f600 " + passage), (9, "a " * 300), (9, "b " * 300), (10, "0" * 500), (11, passage.upper()),
    ]


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def empty(spark, schema=SCHEMA):
    return spark.createDataFrame([], schema)
