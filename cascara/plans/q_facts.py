"""Facts about fitted models that can fail (C1, C6-C8, R1, R2, D1-D3): each query
measures a property that only the right fit has, and the SQL says what it must
be. ``tests/test_facts.py`` substitutes wrong fits and expects other rows."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cascara.operators import cluster as C
from cascara.operators import recommend as R
from cascara.operators import tree as D
from cascara.plans import standins as S
from cascara.plans.q_ml import K_CLUSTERS, PCA_K, SEED, TREE_FEATURES, onehot_features
from cascara.plans.q_segments import _PROF
from cascara.plans.registry import query, r6
from cascara.session import materialize, scratch_path
from cascara.sources import load_table

#: Rounds allowed for a fit that must converge.
CONVERGED = 200


@query("kmeans_optimal", _PROF + """
SELECT count(*) AS "rows", 0::BIGINT AS nearer_elsewhere, 0::BIGINT AS centres_off FROM nem
""")
def q_kmeans_optimal(spark, d):
    """Run to convergence, no row lies nearer to another centre, and every
    centre is the mean of its rows."""
    feats, _ = onehot_features(spark, d)
    model = C.kmeans_fit(feats, K_CLUSTERS, SEED, max_iter=CONVERGED, tol=0.0)
    assigned = materialize(model.transform(feats).select(
        "prediction", vector_to_array("features").alias("x")), "assigned")
    return C.assignment_faults(assigned, C.centre_table(model, spark)).select(
        "rows", "nearer_elsewhere", "centres_off")


@query("kmeans_pca_optimal", _PROF + """
SELECT count(*) AS "rows", 0::BIGINT AS nearer_elsewhere, 0::BIGINT AS centres_off FROM nem
""")
def q_kmeans_pca_optimal(spark, d):
    """The same for the clustering of PCA-reduced rows."""
    feats, cols = onehot_features(spark, d)
    reduced = materialize(C.pca_reduce(feats, min(PCA_K, len(cols))), "reduced")
    model = C.kmeans_fit(reduced, K_CLUSTERS, SEED, "pca_features", max_iter=CONVERGED, tol=0.0)
    assigned = materialize(model.transform(reduced).select(
        "prediction", vector_to_array("pca_features").alias("x")), "assigned")
    return C.assignment_faults(assigned, C.centre_table(model, spark)).select(
        "rows", "nearer_elsewhere", "centres_off")


@query("covariance", _PROF + """
, x AS (SELECT id, rk FROM nocc JOIN topr USING (item)),
n AS (SELECT count(*) AS n FROM nem),
p AS (SELECT a.rk AS i, b.rk AS j, count(*) AS c FROM x a JOIN x b ON a.id = b.id AND a.rk <= b.rk GROUP BY 1, 2)
SELECT CAST(s.rk - 1 AS INTEGER) AS i, CAST(t.rk - 1 AS INTEGER) AS j,
       round((coalesce(p.c, 0) - s.c::DOUBLE * t.c / n) / (n - 1), 6) AS value
FROM topr s JOIN topr t ON s.rk <= t.rk CROSS JOIN n LEFT JOIN p ON p.i = s.rk AND p.j = t.rk
WHERE n > 1
""")
def q_covariance(spark, d):
    """What PCA decomposes, as a table."""
    feats, _ = onehot_features(spark, d)
    return C.covariance(feats.select(vector_to_array("features").alias("x"))).select("i", "j", r6("value").alias("value"))


@query("pca_eigen", _PROF + """
SELECT least(30, count(*)) AS components, 0::BIGINT AS faults FROM topr
""")
def q_pca_eigen(spark, d):
    """The components are orthonormal eigenvectors of the covariance, in
    descending order of variance."""
    feats, cols = onehot_features(spark, d)
    model = C.pca_fit(feats, min(PCA_K, len(cols)))
    cov = materialize(C.covariance(feats.select(vector_to_array("features").alias("x"))), "covariance")
    found = C.eigen_faults(cov, C.component_table(model, spark))
    return found.agg(F.count(F.lit(1)).alias("components"), F.count_if("fault").alias("faults"))


@query("pca_uncorrelated", _PROF + """
SELECT least(30, count(*)) AS components, 0::BIGINT AS correlated, 0::BIGINT AS out_of_order FROM topr
""")
def q_pca_uncorrelated(spark, d):
    """C6 from the reduced rows: their covariance is diagonal and descends."""
    feats, cols = onehot_features(spark, d)
    reduced = C.pca_reduce(feats, min(PCA_K, len(cols))).select(vector_to_array("pca_features").alias("x"))
    cov = materialize(C.covariance(reduced), "covariance")
    top = cov.agg(F.max("value")).scalar()
    own = cov.where("i = j").select(F.col("i").alias("a"), F.col("value").alias("v"))
    after = own.select((F.col("a") - 1).alias("a"), F.col("v").alias("w"))
    worse = own.join(after, "a").withColumn("_top", top).agg(
        F.count_if(F.col("w") > F.col("v") + 1e-6 * F.col("_top"))).scalar()
    return cov.withColumn("_top", top).agg(
        F.count_if(F.col("i") == F.col("j")).alias("components"),
        F.count_if((F.col("i") < F.col("j")) & (F.abs("value") > 1e-6 * F.col("_top"))).alias("correlated"),
    ).withColumn("out_of_order", worse)


_HALVES = """
SELECT label AS a, CAST(embedding[1] > 0 AS INTEGER) + 2 * CAST(embedding[2] > 0 AS INTEGER) AS b FROM embeddings
"""


@query("label_agreement", f"""
WITH e AS ({_HALVES}), c AS (SELECT a, b, count(*) AS n FROM e GROUP BY a, b),
t AS (SELECT (SELECT sum(n) FROM c) AS r, (SELECT sum(n * (n - 1) / 2) FROM c) AS s,
  (SELECT sum(n * (n - 1) / 2) FROM (SELECT sum(n) AS n FROM c GROUP BY a)) AS x,
  (SELECT sum(n * (n - 1) / 2) FROM (SELECT sum(n) AS n FROM c GROUP BY b)) AS y)
SELECT r::BIGINT AS "rows", s::BIGINT AS pairs_together,
       round((s - x * y / (r * (r - 1) / 2)) / ((x + y) / 2 - x * y / (r * (r - 1) / 2)), 6) AS adjusted_rand
FROM t
""")
def q_label_agreement(spark, d):
    """The given labelling against one by the signs of two coordinates."""
    e = load_table(spark, d, "embeddings")
    sign = (F.col("embedding")[0] > 0).cast("int") + 2 * (F.col("embedding")[1] > 0).cast("int")
    return C.adjusted_rand(e, "label", sign).withColumn("adjusted_rand", r6("adjusted_rand"))


@query("label_contingency", f"SELECT a, b, count(*) AS n FROM ({_HALVES}) GROUP BY a, b")
def q_label_contingency(spark, d):
    e = load_table(spark, d, "embeddings")
    return C.contingency(e, "label", (F.col("embedding")[0] > 0).cast("int") + 2 * (F.col("embedding")[1] > 0).cast("int"))


@query("cluster_agreement")
def q_cluster_agreement(spark, d):
    """Clusters of one-hot rows against those of the PCA-reduced ones."""
    feats, cols = onehot_features(spark, d)
    one = C.kmeans_assign(feats, K_CLUSTERS, SEED).select("id", F.col("prediction").alias("onehot"))
    pca = C.kmeans_assign(C.pca_reduce(feats, min(PCA_K, len(cols))), K_CLUSTERS, SEED, features="pca_features")
    return C.adjusted_rand(one.join(pca.select("id", F.col("prediction").alias("pca")), "id"), "onehot", "pca")


# --- recommendation -------------------------------------------------------------

def _train_users(pairs: str) -> str:
    return (f"SELECT count(DISTINCT u) FROM ({pairs}) "
            "WHERE ('0x' || substr(md5('42|' || u || '|' || i), 1, 8))::BIGINT % 100 < 60")


@query("als_optimal", f"""
SELECT 'quantities' AS part, ({_train_users("SELECT DISTINCT o_custkey AS u, l_partkey AS i FROM lineitem "
                                           "JOIN orders ON o_orderkey = l_orderkey")}) AS users,
       0::BIGINT AS unsolved, NULL::BOOLEAN AS beats_item_mean
UNION ALL
SELECT 'letters', ({_train_users("SELECT doc_id AS u, unnest(range(26)) AS i FROM documents WHERE length(text) > 0")}),
       0, true
""")
def q_als_optimal(spark, d):
    """Every user's factors solve that user's normal equations; on ratings
    with a structure the test error is under that of the items' means."""
    out = None
    for part, pairs, point in (("quantities", S.user_item_ratings(spark, d), (7, 0.2, 15)),
                               ("letters", S.letter_shares(spark, d), (7, 0.02, 10))):
        train, _, test = R.hash_split(R.dense_pairs(materialize(pairs, "pairs")), ["user", "item"])
        train = materialize(train, "train")
        model = R.als_fit(train, *point, user="user_no", item="item_no")
        off = R.als_faults(train, model, point[1], "user_no", "item_no")
        row = off.agg(F.count(F.lit(1)).alias("users"), F.count_if(F.col("residual") > 1e-3).alias("unsolved"))
        beats = F.lit(None).cast("boolean")
        if part == "letters":
            scored = R.als_predict(model, test).where("prediction IS NOT NULL")
            means = train.groupBy("item").agg(F.avg("rating").alias("mean"))
            errors = scored.join(means, "item").agg(R.rmse_of().alias("als"), R.rmse_of("rating", "mean").alias("mean"))
            beats = errors.select(F.col("als") < F.col("mean")).scalar()
        row = row.select(F.lit(part).alias("part"), "users", "unsolved", beats.alias("beats_item_mean"))
        out = row if out is None else out.unionAll(row)
    return out


@query("als_grid_check", """
SELECT 8::BIGINT AS points, 0::BIGINT AS wrong, 1::BIGINT AS test_values, 0::BIGINT AS best_wrong
""")
def q_als_grid_check(spark, d):
    """R2: every validation RMSE of a grid recomputed from the stored factors, and
    the one test RMSE, which belongs to the best point."""
    ratings, kept = R.dense_pairs(materialize(S.user_item_ratings(spark, d), "pairs")), scratch_path(spark, "factors")
    grid = materialize(R.als_grid(ratings, (4, 7), (0.1, 0.3), (5, 10), user="user_no", item="item_no",
                                  factors=kept), "grid")
    _, val, test = R.hash_split(ratings, ["user_no", "item_no"])
    point = ["k", "regularization", "iterations"]
    again = R.score_grid(val, kept, "user_no", "item_no").withColumnsRenamed({"rmse": "val", "scored": "val_scored"})
    again = again.join(R.score_grid(test, kept, "user_no", "item_no").withColumnRenamed("rmse", "test"), point)

    def apart(a, b):
        return F.abs(F.col(a) - F.col(b)) > 1e-5 * F.col(b)

    wrong = (F.coalesce(apart("validation_rms", "val"), F.lit(True))
             | ~F.col("validation_scored").eqNullSafe(F.col("val_scored"))
             | F.coalesce(apart("testing_rms", "test"), F.lit(False)))
    least = again.agg(F.min("val")).scalar()
    best = F.col("testing_rms").isNotNull() & (F.col("val") > F.col("_least") * (1 + 1e-5))
    return grid.join(again, point, "left").withColumn("_least", least).agg(
        F.count(F.lit(1)).alias("points"), F.count_if(wrong).alias("wrong"),
        F.count("testing_rms").alias("test_values"), F.count_if(best).alias("best_wrong"))


# --- decision trees ---------------------------------------------------------------

@query("tree_routed", """
SELECT (SELECT count(*) FROM documents) AS documents, 0::BIGINT AS disagree, 0::BIGINT AS leaves_off,
       0::BIGINT AS not_majority, true AS beats_majority
""")
def q_tree_routed(spark, d):
    """The node table sends every document to the leaf the model gives it;
    the leaves' class counts are those of the training rows routed there, and
    their predictions the most frequent class. The tree beats the larger class."""
    train = materialize(S.tree_rows(spark, d), "tree-rows")
    model = D.tree_fit(train, TREE_FEATURES, max_depth=5)
    nodes, depth = materialize(D.tree_nodes(model, TREE_FEATURES), "tree-nodes"), model.stages[-1].depth
    everyone = model.transform(S.tree_rows(spark, d, unlabelled=True)).select("doc_id", *TREE_FEATURES, "prediction")
    sent = D.route(everyone, nodes, TREE_FEATURES, depth)
    routed = materialize(D.route(train, nodes, TREE_FEATURES, depth), "routed")
    leaves = D.leaf_faults(routed, nodes).agg(F.count_if("counts_off").alias("a"), F.count_if("not_majority").alias("b"))
    won = routed.agg((F.count_if(F.col("routed") == F.col("label")) > F.greatest(
        F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1))).alias("w"))
    return sent.agg(F.count(F.lit(1)).alias("documents"),
                    F.count_if(F.col("routed") != F.col("prediction")).alias("disagree")).withColumns({
        "leaves_off": leaves.select("a").scalar(), "not_majority": leaves.select("b").scalar(),
        "beats_majority": won.scalar()})


@query("tree_folds", """
SELECT doc_id, quality::DOUBLE AS label, CAST((row_number() OVER (
         ORDER BY quality NULLS FIRST, md5('42|' || doc_id), doc_id) - 1) % 5 AS INTEGER) AS fold
FROM documents JOIN labels USING (doc_id)
""")
def q_tree_folds(spark, d):
    """Each labelled document in one of five folds, classes spread evenly."""
    return D.stratified_folds(S.tree_rows(spark, d).select("doc_id", "label"))


@query("tree_cross_validate", """
SELECT max_depth, min_instances, (SELECT count(quality) FROM documents JOIN labels USING (doc_id)) AS scored,
       1::BIGINT AS winners, true AS within_rule
FROM (VALUES (2), (4)) AS x(max_depth), (VALUES (1), (20)) AS y(min_instances)
""")
def q_tree_cross_validate(spark, d):
    """Every labelled row is scored once per grid point; one point wins, and
    its mean is within one standard error of the highest."""
    got = D.tree_cross_validate(S.tree_rows(spark, d), TREE_FEATURES, depths=(2, 4), min_instances=(1, 20), folds=3)
    one = got.agg(F.count_if("is_best").alias("w"), F.max(F.struct("mean_accuracy", "error")).alias("top"),
                  F.max(F.when(F.col("is_best"), F.col("mean_accuracy"))).alias("m"))
    return got.select("max_depth", "min_instances", "scored").withColumns({
        "winners": one.select("w").scalar(),
        "within_rule": one.select(F.col("m") >= F.col("top.mean_accuracy") - F.col("top.error")).scalar()})
