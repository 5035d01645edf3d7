"""Fixture rows with nulls, empty and long texts, ties, repeated rows and clashing\ncolumn names."""

import pytest
from pyspark.sql import types as T

CLASHING = ["row", "n_words", "size", "content", "target", "shift", "stratum", "good", "k", "line", "fp",
            "root", "y", "_", "_content", "_copy", "_cutoffs", "_doc", "_drop", "_id", "_kept", "_key",
            "_row", "_source", "_spans", "_stratum", "_text"]
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # Names that results or helpers also use.
    *(T.StructField(c, T.StringType()) for c in CLASHING),
])

_LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
TEXTS = [
    (1, "Alpha beta gamma.\nSame line here\nAlpha beta gamma.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, "b"),
    (4, " \t\n\x0b\x0c\r ", "de", None),
    (5, "Same line here\nzwei  drei   vier\n\n\n fünf sechs sieben", "de", "b"),
    (5, "another text of the same id", "de", "b"),
    (6, "Same line here\n" + _LONG, "fr", "c"),
    (7, "Same line here\n" + _LONG, "fr", "c"),
    (7, "Same line here\n" + _LONG, "fr", "c"),
    (None, "Same line here\n" + _LONG[:50_000], None, None),
    (8, "a <|endoftext|> b  <|endoftext|>\x1cc!\x1c! \x85 it's I'LL 123 45 ###%% \\0\\a", "en", "d"),
    (9, "Same line here", "en", "e"),
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(
        [(*r, len(r[1] or ""), *CLASHING) for r in TEXTS], DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
