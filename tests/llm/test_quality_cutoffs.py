import numpy as np
from pyspark.sql import functions as F

from cascara.llm import quality_model as qm
from cascara.sources.tables import load_table

SF_LARGE = "/root/testdata/sf0.1"


def test_cutoff_keeps_its_limit():
    rng = np.random.default_rng(3)
    assert qm.cutoff(rng.random(198), 0.005) == 0.5  # too few to tell
    lost = []
    for _ in range(300):
        at = qm.cutoff(rng.random(999), 0.005)
        lost.append(at)  # uniform scores: the chance to fall below is the cutoff
    assert 0.004 <= np.mean(lost) <= 0.0055


def test_toxic_documents_have_a_target_of_their_own(spark):
    docs, labels = load_table(spark, SF_LARGE, "documents"), load_table(spark, SF_LARGE, "labels")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    out = qm.classify(docs, labels.where(half)).join(labels.where(~half), "doc_id").toPandas()
    good, toxic = (out["quality"] == 1) & (out["toxic"] == 0), out["toxic"] == 1
    assert out.loc[toxic, "rejected"].mean() >= 0.84
    assert out.loc[good, "rejected"].mean() <= 0.01
