import hashlib
from zlib import crc32

from pyspark.sql import functions as F

from cascara.llm import quality_model as qm


def test_pseudo_labels_come_from_all_documents_and_bring_new_words(spark):
    # Labelled: bad documents come from one source. Of 8,400 others the 200 last by
    # the hash of their id come from it too, and only they hold a word of their own.
    order = sorted(range(1000, 9400), key=lambda k: hashlib.md5(f"{k}:co-training".encode()).hexdigest())
    last = set(order[-200:])
    rows = [(k, f"plain words {k}", "bad" if k % 2 else "fine") for k in range(1000)]
    rows += [(k, f"plain words {k}" + " freshword" * (k in last), "bad" if k in last else "other")
             for k in range(1000, 9400)]
    rows += [(9400, "plain freshword", None), (None, "plain freshword without an id", "bad")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {"lang": F.lit("en"), "n_chars": F.length("text").cast("long")})
    labels = spark.createDataFrame([(k, 1 - k % 2, 0) for k in range(1000)],
                                   "doc_id long, quality int, toxic int")
    model = qm.fit_model(docs, labels, F.col("quality") == 1, F.lit(False), sure=0.9)
    at = model.numbers("content", [crc32(b"freshword")])
    assert len(at) == 1 and model.views["content"].w[at[0]] < 0


def test_copies_are_one_candidate(spark):
    # 900 copies of one bad document must not keep the 300 different ones out.
    rows = [(k, f"plain words {k}", "bad" if k % 2 else "fine") for k in range(600)]
    rows += [(k, "copied", "bad") for k in range(600, 1500)]
    rows += [(k, f"freshword {k}", "bad") for k in range(1500, 1800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {"lang": F.lit("en"), "n_chars": F.length("text").cast("long")})
    labels = spark.createDataFrame([(k, 1 - k % 2, 0) for k in range(600)],
                                   "doc_id long, quality int, toxic int")
    model = qm.fit_model(docs, labels, F.col("quality") == 1, F.lit(False), sure=0.9, rounds=1)
    assert len(model.numbers("content", [crc32(b"freshword")])) == 1
