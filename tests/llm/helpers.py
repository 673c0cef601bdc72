"""Rows with every kind of edge case, and plain versions of shared parts."""

from pyspark.sql import types as T

LONG = " ".join(f"word{i % 977} x{i}" for i in range(20_000))
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])


def table(spark, rows, extra=()):
    """A documents table of (doc_id, text) rows; ``extra`` names columns that
    clash with an operator's own."""
    schema = T.StructType([*SCHEMA.fields, *[T.StructField(c, T.StringType()) for c in extra]])
    full = [(i, t, "en", "s", None if t is None else len(t), *["clash"] * len(extra)) for i, t in rows]
    return spark.createDataFrame(full, schema)


EDGES = [(1, None), (2, ""), (3, "   "), (4, "one"), (None, "a text without an id, of nine words or so"),
         (5, LONG), (6, LONG), (7, "same\nlines\nhere"), (7, "same\nlines\nhere"), (8, "same\nlines\nhere"),
         (9, "é\u00a0ü\u2003x \t\n\n  y"), (10, "0 1 2"), (11, "\x00nul\x00 and 👍🏽 emoji")]


def text_of(x):
    return x or ""
