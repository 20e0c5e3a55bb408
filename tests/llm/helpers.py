"""Fixtures shared by the tests of the training-data operators."""

from pyspark.sql import types as T

ODD = ["", " ", "\n", "  a  b", "x\n y", "a \n b", "tab\there", "'s 're  n't", "é à  ü", "日本 語 テキスト",
       "<|endoftext|>", " a<|endoftext|> b <|endoftext|>", "a " * 4000, "word" * 900, " a  b",
       "\x1c a \x1f b", "1 22  333!!", None]
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def documents(spark, texts, langs=None, ids=None, parts=3):
    """The given texts as a `documents` table, numbered from 0."""
    ids = ids or list(range(len(texts)))
    langs = langs or [None] * len(texts)
    rows = [(i, t, g, "s", None if t is None else len(t)) for i, t, g in zip(ids, texts, langs)]
    return spark.createDataFrame(rows, DOCS).repartition(parts)
