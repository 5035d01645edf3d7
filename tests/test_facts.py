"""The facts of q_facts fail for wrong fits, and their operators agree with
plain numpy on small tables."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cascara.operators import cluster as C
from cascara.operators import recommend as R
from cascara.operators import tree as D
from cascara.session import materialize, scratch_path


@pytest.fixture(scope="module")
def points(spark):
    """Three clouds, with duplicates and zeros."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.3, (40, 4)) for c in ((0, 0, 0, 0), (5, 0, 1, 0), (0, 6, 0, -2))])
    x[::7] = x[0]
    x[:, 3][::3] = 0.0
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    return materialize(spark.createDataFrame(rows, "id long, x array<double>").withColumn(
        "features", array_to_vector("x")), "points"), x


def faults(assigned, centres, **options):
    return C.assignment_faults(assigned, centres, **options).first().asDict()


@pytest.fixture(scope="module")
def fitted(points):
    return C.kmeans_fit(points[0], 3, 1, max_iter=200, tol=0.0)


@pytest.mark.parametrize("block", [1, 2, 50])
def test_kmeans_facts_hold(spark, points, fitted, block):
    got = faults(fitted.transform(points[0]), C.centre_table(fitted, spark), block=block)
    assert (got["rows"], got["nearer_elsewhere"], got["centres_off"]) == (120, 0, 0)


@pytest.mark.parametrize("wrong, off", [("0", True), ("CAST(id % 3 AS int)", True), ("CAST(NULL AS int)", False)])
def test_kmeans_facts_fail_for_other_assignments(spark, points, fitted, wrong, off):
    got = faults(points[0].withColumn("prediction", F.expr(wrong)), C.centre_table(fitted, spark))
    assert got["nearer_elsewhere"] > 20 and (got["centres_off"] > 0) == off


def test_kmeans_facts_fail_for_other_centres(spark, points, fitted):
    moved = C.centre_table(fitted, spark).withColumn("centre", F.transform("centre", lambda v: v + 0.01))
    assert faults(fitted.transform(points[0]), moved)["centres_off"] == 3


def test_nearest_centre_equals_numpy(spark, points):
    x = points[1]
    rng = np.random.default_rng(4)
    c = rng.normal(0, 4, (23, 4))
    c[5] = c[11]  # a tie
    centres = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(c)], "cluster_id int, centre array<double>")
    d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    got = {r["id"]: r for r in C.nearest_centre(points[0].select("id", "x"), centres, block=5).collect()}
    for i in range(len(x)):
        assert got[i]["nearest"] == d[i].argmin() and abs(got[i]["distance"] - d[i].min()) < 1e-9
    none = C.nearest_centre(spark.createDataFrame([(1, None)], "id int, x array<double>"), centres).first()
    assert none["nearest"] is None and none["distance"] is None
    assert C.nearest_centre(points[0], centres.where("false")).where("nearest IS NOT NULL").count() == 0


def cov_matrix(frame, n):
    out = np.zeros((n, n))
    for r in frame.collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["value"]
    return out


def test_covariance_equals_numpy(spark, points):
    assert np.allclose(cov_matrix(C.covariance(points[0]), 4), np.cov(points[1].T))
    sparse = spark.createDataFrame([([1.0, 0.0, 0.0],), ([0.0, 2.0, 0.0],), (None,), ([0.0, 0.0, 0.0],)], "x array<double>")
    want = np.cov(np.array([[1.0, 0, 0], [0, 2, 0], [0, 0, 0]]).T)
    assert np.allclose(cov_matrix(C.covariance(sparse), 3), want)
    assert C.covariance(sparse.limit(1)).count() == 0


def test_eigen_facts(spark, points):
    frame = points[0]
    cov = materialize(C.covariance(frame), "cov")
    table = C.component_table(C.pca_fit(frame, 4), spark)
    assert [r["fault"] for r in C.eigen_faults(cov, table).collect()] == [False] * 4
    assert np.allclose(sorted(r["variance"] for r in C.eigen_faults(cov, table).collect()),
                       np.sort(np.linalg.eigvalsh(np.cov(points[1].T))))
    identity = spark.createDataFrame([(c, j, float(c == j)) for c in range(4) for j in range(4)], table.schema)
    assert C.eigen_faults(cov, identity).where("fault").count() > 1
    swapped = table.withColumn("component", F.lit(3) - F.col("component"))
    assert C.eigen_faults(cov, swapped).where("fault").count() == 3
    doubled = table.withColumn("v", F.col("v") * 2)
    assert C.eigen_faults(cov, doubled).where("fault").count() == 4


def rand_index(a, b):
    """By all pairs of rows."""
    n = len(a)
    pairs = [(a[i] == a[j], b[i] == b[j]) for i in range(n) for j in range(i)]
    both, x, y = sum(p and q for p, q in pairs), sum(p for p, _ in pairs), sum(q for _, q in pairs)
    chance = x * y / len(pairs)
    return (both - chance) / ((x + y) / 2 - chance)


def test_adjusted_rand(spark):
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 4, 60).tolist(), rng.integers(0, 3, 60).tolist()
    b[:30] = a[:30]
    frame = spark.createDataFrame([(x if x else None, y) for x, y in zip(a, b)], "a int, b int")
    got = C.adjusted_rand(frame, "a", "b").first()
    assert got["rows"] == 60 and abs(got["adjusted_rand"] - rand_index(a, b)) < 1e-9
    assert C.adjusted_rand(frame, "a", F.col("a") + 7).first()["adjusted_rand"] == 1.0
    assert C.adjusted_rand(frame, F.lit(1), F.lit(2)).first()["adjusted_rand"] is None
    assert tuple(C.adjusted_rand(frame.where("false"), "a", "b").first()) == (0, 0, None)


@pytest.fixture(scope="module")
def ratings(spark):
    rng = np.random.default_rng(6)
    u, v = rng.normal(1, 0.5, (30, 2)), rng.normal(1, 0.5, (20, 2))
    rows = [(a, b, float(u[a] @ v[b] + rng.normal(0, 0.1))) for a in range(30) for b in range(20) if (a * b) % 3]
    rows += [(0, b, 1.0) for b in range(20)] * 3  # repeated rows
    return materialize(spark.createDataFrame(rows, "user int, item int, rating float"), "small-ratings")


def test_normal_equations(ratings):
    model = R.als_fit(ratings, 3, 0.1, 5)
    got = R.als_faults(ratings, model, 0.1)
    assert got.count() == ratings.select("user").distinct().count()
    assert got.where("residual > 1e-3").count() == 0
    assert R.als_faults(ratings, model, 0.3).where("residual > 1e-3").count() == got.count()
    changed = ratings.withColumn("rating", F.col("rating") + (F.col("user") == 5).cast("int"))
    assert [r["user"] for r in R.als_faults(changed, model, 0.1).where("residual > 1e-3").collect()] == [5]


def test_grid_scores_in_one_pass(spark, ratings):
    kept = scratch_path(spark, "factors")
    grid = {tuple(r)[:3]: r for r in R.als_grid(ratings, (2, 3), (0.1,), (2, 4), factors=kept).collect()}
    _, val, test = R.hash_split(ratings, ["user", "item"])
    again = {tuple(r)[:3]: r for r in R.score_grid(val, kept).collect()}
    assert set(grid) == set(again)
    for p, r in grid.items():
        assert abs(r["validation_rms"] - again[p]["rmse"]) < 1e-5 and r["validation_scored"] == again[p]["scored"]
    best = [p for p, r in grid.items() if r["testing_rms"] is not None]
    assert best == [min(grid, key=lambda p: grid[p]["validation_rms"])]
    scores = {tuple(r)[:3]: r["rmse"] for r in R.score_grid(test, kept).collect()}
    assert abs(scores[best[0]] - grid[best[0]]["testing_rms"]) < 1e-5


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(7)
    rows = [(i, float(rng.integers(0, 50)), float(rng.normal()), str(rng.choice(list("abc"))),
             float((i % 5 == 0) or rng.random() < 0.2)) for i in range(400)]
    rows = [(i, a, b, c, y if c != "a" else float(a > 20)) for i, a, b, c, y in rows]
    return materialize(spark.createDataFrame(rows, "doc_id long, a double, b double, c string, label double"), "labelled")


def test_router_follows_the_model(spark, labelled):
    features = ["a", "b", "c"]
    model = D.tree_pipeline(features, "label", 4, categorical=["c"]).fit(labelled)
    nodes = materialize(D.tree_nodes(model, features), "nodes")
    assert nodes.where("left_categories IS NOT NULL").count() > 0
    data = model.transform(labelled).withColumns({"text_c": F.col("c"), "c": F.col("c_index")})
    data = data.select("doc_id", "a", "b", "c", "label", "prediction")
    depth = model.stages[-1].depth
    for limit in (1 << 24, 0):
        routed = D.route(data, nodes, features, depth, limit)
        assert routed.columns == [*data.columns, "leaf", "routed"] and routed.count() == 400
        assert routed.where("routed <> prediction").count() == 0
    bad = D.leaf_faults(routed, nodes)
    assert bad.where("counts_off OR not_majority").count() == 0 and bad.agg(F.sum("rows")).first()[0] == 400
    # A tree cut to its root, and leaves that say the opposite, are found out.
    stump = nodes.where("node_id = 0").withColumns({"left_child": F.lit(None).cast("int"), "is_prediction": F.lit(True)})
    assert D.route(data, stump, features, 1).where("routed <> prediction").count() > 0
    flipped = nodes.withColumn("prediction", 1 - F.col("prediction"))
    assert D.leaf_faults(D.route(data, flipped, features, depth), flipped).where("not_majority").count() > 0
    fewer = data.where("doc_id % 7 <> 0")
    assert D.leaf_faults(D.route(fewer, nodes, features, depth), nodes).where("counts_off").count() > 0


def test_folds_are_even_in_every_class(spark, labelled):
    frame = labelled.withColumn("label", F.when(F.col("doc_id") < 3, None).otherwise(F.col("label")))
    folds = D.stratified_folds(frame, folds=7)
    assert folds.count() == 400 and folds.columns == [*frame.columns, "fold"]
    for r in folds.groupBy("label").pivot("fold", list(range(7))).count().fillna(0).collect():
        sizes = list(r)[1:]
        assert max(sizes) - min(sizes) <= 1
    again = D.stratified_folds(frame.repartition(5), folds=7)
    assert again.exceptAll(folds.select(again.columns)).count() == 0
    assert D.stratified_folds(frame.where("false")).count() == 0


def test_cross_validation(labelled):
    got = D.tree_cross_validate(labelled, ["a", "b"], depths=(1, 3), min_instances=(1, 30), folds=3).collect()
    assert [r["scored"] for r in got] == [400] * 4 and sum(r["is_best"] for r in got) == 1
    top = max(got, key=lambda r: r["mean_accuracy"])
    allowed = [r for r in got if r["mean_accuracy"] >= top["mean_accuracy"] - top["error"]]
    best = min(allowed, key=lambda r: (r["max_depth"], -r["min_instances"]))
    assert best["is_best"]
    rows = D.stratified_folds(labelled, folds=3, out="_fold")
    shares = []
    for k in range(3):
        model = D.tree_fit(rows.where(F.col("_fold") != k), ["a", "b"], max_depth=3, min_instances=1)
        one = model.transform(rows.where(F.col("_fold") == k))
        shares.append(one.where("prediction = label").count() / one.count())
    mine = next(r for r in got if (r["max_depth"], r["min_instances"]) == (3, 1))
    assert abs(mine["mean_accuracy"] - np.mean(shares)) < 1e-9 and abs(mine["spread"] - np.std(shares, ddof=1)) < 1e-9
