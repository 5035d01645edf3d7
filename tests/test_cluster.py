import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from cascara.operators import cluster as C
from cascara.sources import load_table
from conftest import SF_MID


def test_lazy_silhouette_equals_evaluator(spark):
    emb = load_table(spark, SF_MID, "embeddings")
    lazy = C.silhouette(emb, "embedding", "label", 64).first()["silhouette"]
    vec = emb.select(array_to_vector("embedding").alias("features"),
                     F.col("label").cast("double").alias("prediction"))
    assert lazy == pytest.approx(C.silhouette_evaluator(vec), abs=1e-9)


def test_singleton_cluster_scores_zero(spark):
    df = spark.createDataFrame([([0.0, 0.0], 0), ([0.0, 1.0], 0), ([10.0, 10.0], 1)],
                               "x array<double>, c int")
    vec = df.select(array_to_vector("x").alias("features"), F.col("c").cast("double").alias("prediction"))
    lazy = C.silhouette(df, "x", "c", 2).first()["silhouette"]
    assert lazy == pytest.approx(C.silhouette_evaluator(vec), abs=1e-12)


def test_duplicate_points_score_as_the_evaluator_says(spark):
    rows = [([0.0, 1.0], 0)] * 3 + [([0.0, 1.0], 1)] * 2 + [([1.0, 0.0], 2)] * 4 + [([1.0, 1.0], 3)]
    df = spark.createDataFrame(rows, "x array<double>, c int")
    vec = df.select(array_to_vector("x").alias("features"), F.col("c").cast("double").alias("prediction"))
    lazy = C.silhouette(df, "x", "c").first()["silhouette"]
    assert lazy == pytest.approx(C.silhouette_evaluator(vec), abs=1e-12)
    same = spark.createDataFrame([([1.0], 0), ([1.0], 0), ([1.0], 1), ([1.0], 1)], "x array<double>, c int")
    assert C.silhouette(same, "x", "c").first()["silhouette"] == 0.0


def test_kmeans_assigns_the_nearest_centre(spark):
    rows = [([float(i % 7), float(i % 5), float(i % 3)],) for i in range(200)]
    df = spark.createDataFrame(rows, "x array<double>").select(array_to_vector("x").alias("features"), "x")
    model = C.kmeans_fit(df, 6, 123)
    centres = model.clusterCenters()
    for r in model.transform(df).collect():
        d = [sum((a - b) ** 2 for a, b in zip(r["x"], c)) for c in centres]
        assert d[r["prediction"]] == pytest.approx(min(d), abs=1e-9)


def test_kmeans_profile_equals_centres_and_sizes_sum(spark):
    rows = [([float(i % 3 == 0), float(i % 5 == 0), float(i % 2)], i % 4 == 0) for i in range(200)]
    df = spark.createDataFrame(rows, "x array<double>, flag boolean").select(
        array_to_vector("x").alias("features"), "flag", "x")
    model = C.kmeans_fit(df, 4, 123)
    pred = model.transform(df)
    sizes = C.cluster_sizes(pred).collect()
    assert sum(r["size"] for r in sizes) == 200  # every row assigned exactly once
    assert pred.where(F.col("prediction").isNull()).count() == 0
    prof = C.cluster_profile(pred, "prediction", "flag", {f"f{i}": F.col("x")[i] for i in range(3)})
    centres = model.clusterCenters()
    for r in prof.collect():
        assert [r["f0"], r["f1"], r["f2"]] == pytest.approx(list(centres[r["cluster_id"]]), abs=1e-9)
        assert 0.0 <= r["flag_ratio"] <= 1.0


def test_pca_reduces_dimension(spark):
    df = spark.createDataFrame([([float(i), float(2 * i), float(i % 3)],) for i in range(50)],
                               "x array<double>").select(array_to_vector("x").alias("features"))
    out = C.pca_reduce(df, 2).select(vector_to_array("pca_features").alias("p")).first()["p"]
    assert len(out) == 2


def test_kmeans_is_deterministic_and_centres_match(spark):
    rows = [([float(i % 3 == 0), float(i % 5 == 0), float(i % 2)],) for i in range(300)]
    df = spark.createDataFrame(rows, "x array<double>").select(array_to_vector("x").alias("features"))
    a = C.kmeans_fit(df, 4, 123)
    b = C.kmeans_fit(df, 4, 123)
    assert [list(c) for c in a.clusterCenters()] == [list(c) for c in b.clusterCenters()]
    cent = C.cluster_centres(a.transform(df), "prediction").collect()
    for r in cent:
        assert list(r["centre"].toArray()) == pytest.approx(list(a.clusterCenters()[r["cluster_id"]]))


def test_silhouette_works_a_point_out_once(spark):
    rows = [([float(i % 4 == j) for j in range(6)], i % 3) for i in range(40)]
    df = spark.createDataFrame(rows, "x array<double>, c int")
    out = C.silhouette(df, "x", "c", 6)
    vec = df.select(array_to_vector("x").alias("features"), F.col("c").cast("double").alias("prediction"))
    assert out.first()["silhouette"] == pytest.approx(C.silhouette_evaluator(vec), abs=1e-12)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # What runs for every cluster multiplies no whole vectors.
    each = plan.split(".stats, lambdafunction(")[1].split(" AS _d#")[0]
    assert "aggregate(" in each and "zip_with" not in each.split(", array(")[0]


def test_silhouette_of_odd_vectors(spark):
    rows = [([0.0, 1.0], 0), ([0.0, 1.0], 0), ([4.0, 0.0], 1), ([4.0, 0.0], 1), ([None, 1.0], 0), (None, 1)]
    df = spark.createDataFrame(rows, "x array<double>, c int")
    got = C.silhouette(df, "x", "c", 2).first()["silhouette"]
    assert 0.0 < got < 1.0  # rows without distances score 0 and count
