"""Clustering: k-means, PCA, silhouette and per-cluster profiles.

The reference builds profiles with 2 x k count jobs and a driver-side frame;
here a profile is ONE grouped aggregate. Silhouette is offered twice: MLlib's
``ClusteringEvaluator`` (an action) and a lazy DataFrame form of the same
squared-Euclidean formula that needs only per-cluster sums, so its cost is
O(rows x clusters x dims) without any pairwise distance.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, PCAModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cascara.session import materialize


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def kmeans_fit(df: DataFrame, k: int, seed: int, features: str = "features",
               prediction: str = "prediction", max_iter: int = 20, tol: float = 1e-4) -> KMeansModel:
    """Fit (an action: iterative jobs, centres broadcast per round). Rounds
    stop when no centre moves by more than ``tol``."""
    est = KMeans(featuresCol=features, predictionCol=prediction, k=k, seed=seed, maxIter=max_iter, tol=tol)
    return est.fit(df)


def kmeans_assign(df: DataFrame, k: int, seed: int, features: str = "features",
                  prediction: str = "prediction", max_iter: int = 20) -> DataFrame:
    """Rows with their cluster id (the fit runs eagerly)."""
    return kmeans_fit(df, k, seed, features, prediction, max_iter).transform(df)


def centre_table(model: KMeansModel, spark: SparkSession) -> DataFrame:
    """The fitted centres as rows (cluster_id, centre): as many as clusters."""
    rows = [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster_id int, centre array<double>")


def nearest_centre(points: DataFrame, centres: DataFrame, x: str = "x", block: int = 50) -> DataFrame:
    """``points`` plus nearest (the cluster_id of least squared distance, the
    least id of equal ones) and distance.

    Centres come a block at a time, each a scalar subquery of ``block`` rows; a
    point keeps its best so far, so neither side is exploded or shuffled. Only
    the non-zero coordinates of a point are multiplied: with ``n`` of them a
    point costs ``n`` times the number of centres. Without centres, and for a
    NULL point, both results are NULL.
    """
    numbered = centres.select(
        F.row_number().over(Window.orderBy("cluster_id")).alias("_no"),  # one row a cluster
        F.struct(F.col("cluster_id").alias("id"), F.col("centre").alias("c"),
                 _dot(F.col("centre"), F.col("centre")).alias("q")).alias("_t"))
    blocks = -(-centres.count() // block)
    v = _col(x)
    out = points.withColumns({
        "_at": F.filter(F.sequence(F.lit(0), F.size(v) - 1), lambda i: F.get(v, i) != 0),
        "_xx": _dot(v, v), "_best": F.lit(None).cast("struct<d:double,id:int>")})
    for b in range(blocks):
        part = numbered.where((F.col("_no") > b * block) & (F.col("_no") <= (b + 1) * block))
        out = out.withColumn("_block", part.agg(F.collect_list("_t")).scalar())
        here = F.array_min(F.transform("_block", lambda t: F.struct(
            (F.col("_xx") + t["q"] - 2 * F.aggregate(
                "_at", F.lit(0.0), lambda s, i: s + F.get(v, i) * F.get(t["c"], i))).alias("d"),
            t["id"].cast("int").alias("id"))))
        # least() skips NULL: the first block has no rival.
        out = out.withColumn("_best", F.least("_best", here)).drop("_block")
    known = F.col("_xx").isNotNull()
    return out.select(*points.columns, F.when(known, F.col("_best.id")).alias("nearest"),
                      F.when(known, F.greatest(F.col("_best.d"), F.lit(0.0))).alias("distance"))


def assignment_faults(assigned: DataFrame, centres: DataFrame, x: str = "x",
                      prediction: str = "prediction", tol: float = 1e-6, block: int = 50) -> DataFrame:
    """C1, judged: one row (rows, nearer_elsewhere, centres_off, max_off).

    ``nearer_elsewhere`` counts rows that lie nearer (squared distance, beyond
    ``tol`` of it) to another centre than to that of their cluster, rows without
    one included; ``centres_off`` the centres of non-empty clusters that are
    further than ``tol`` from the mean of their rows, by any coordinate;
    ``max_off`` is the greatest such distance. A converged k-means has none of
    either; any other assignment has.
    """
    near = nearest_centre(assigned.select(x, F.col(prediction).cast("int").alias("_c")), centres, x, block)
    own = centres.select(F.col("cluster_id").cast("int").alias("_c"), F.col("centre").alias("_own"))
    apart = F.zip_with(_col(x), "_own", lambda a, b: (a - b) * (a - b))
    mine = F.aggregate(apart, F.lit(0.0), lambda s, d: s + d)
    rows = near.join(own, "_c", "left").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.coalesce(mine > F.col("distance") + tol * (1 + F.col("distance")), F.lit(True)))
        .alias("nearer_elsewhere"))
    means = (assigned.select(F.col(prediction).cast("int").alias("_c"), F.posexplode(x).alias("i", "v"))
             .groupBy("_c", "i").agg(F.avg("v").alias("mean")))
    off = (means.join(own.select("_c", F.posexplode("_own").alias("i", "at")), ["_c", "i"])
           .groupBy("_c").agg(F.max(F.abs(F.col("mean") - F.col("at"))).alias("off"))
           .agg(F.count_if(F.col("off") > tol).alias("centres_off"),
                F.coalesce(F.max("off"), F.lit(0.0)).alias("max_off")))
    # Two rows of one: each aggregate has one row.
    return rows.withColumns({c: off.select(c).scalar() for c in ("centres_off", "max_off")})


def cluster_sizes(pred: DataFrame, prediction: str = "prediction") -> DataFrame:
    """(cluster_id, size); only non-empty clusters appear."""
    return pred.groupBy(F.col(prediction).alias("cluster_id")).agg(
        F.count(F.lit(1)).alias("size"))


def cluster_profile(pred: DataFrame, cluster: str | Column, flag: str | Column | None,
                    features: dict[str, Column]) -> DataFrame:
    """Per cluster its size, the share of flagged rows and the mean
    of every feature, in ONE aggregate. With the clustering's own input
    features the means are the cluster centres."""
    aggs = [F.count(F.lit(1)).alias("size")]
    if flag is not None:
        aggs.append(F.avg(_col(flag).cast("double")).alias("flag_ratio"))
    aggs += [F.avg(c.cast("double")).alias(name) for name, c in features.items()]
    return pred.groupBy(_col(cluster).alias("cluster_id")).agg(*aggs)


def cluster_centres(pred: DataFrame, cluster: str | Column, features: str = "features") -> DataFrame:
    """C5 on a vector column (any width, e.g. a sparse one-hot of large k):
    (cluster_id, size, centre) with ``Summarizer.mean`` in one aggregate."""
    from pyspark.ml.stat import Summarizer

    return pred.groupBy(_col(cluster).alias("cluster_id")).agg(
        F.count(F.lit(1)).alias("size"), Summarizer.mean(F.col(features)).alias("centre"))


def silhouette_evaluator(pred: DataFrame, features: str = "features",
                         prediction: str = "prediction") -> float:
    """C3 via MLlib (squared Euclidean). Action."""
    ev = ClusteringEvaluator(featuresCol=features, predictionCol=prediction,
                             metricName="silhouette", distanceMeasure="squaredEuclidean")
    return ev.evaluate(pred)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def silhouette(df: DataFrame, x: str | Column, cluster: str | Column,
               dim: int | None = None) -> DataFrame:
    """C3, lazily: mean silhouette with squared Euclidean distance.

    For a point x and cluster C with n points, sum s and sum of squared norms
    q, the mean squared distance from x to C is |x|^2 - 2 x.s/n + q/n. The
    own-cluster mean excludes x itself (times n/(n-1)); a point alone in its
    cluster scores 0, and so does one whose two distances are both 0. Only the
    non-zero coordinates of a point are multiplied, as in :func:`nearest_centre`. Without
    ``dim`` the vectors' length is read from the data (a small action). The per-cluster statistics (one entry per cluster,
    bounded by the number of clusters) are a scalar subquery.
    """
    pts = df.select(_col(cluster).cast("double").alias("c"),
                    F.transform(_col(x), lambda v: v.cast("double")).alias("x"))
    if dim is None:
        dim = pts.agg(F.max(F.size("x"))).first()[0] or 0
    stats = pts.groupBy("c").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(F.col("x")[i]) for i in range(dim)]).alias("s"),
        F.sum(_dot(F.col("x"), F.col("x"))).alias("q"),
    )
    table = stats.agg(F.collect_list(F.struct("c", "n", "s", "q"))).scalar()
    # The subquery is bound to a column first: higher-order functions may not
    # contain subqueries themselves.
    # A NULL coordinate stays, and so does a vector of another length as NULL: neither has distances.
    at = F.filter(F.transform("x", lambda v, i: F.struct(i.alias("i"), v.alias("v"))),
                  lambda e: ~e["v"].eqNullSafe(F.lit(0.0)))
    # The optimizer would move what a lambda reads into it, to be worked out again
    # for every cluster; the one element of an array is worked out once a row.
    point = F.array(F.struct(_dot(F.col("x"), F.col("x")).alias("xx"), F.when(F.size("x") == dim, at).alias("at"),
                             F.col("_stats").alias("stats")))
    pts = pts.withColumn("_stats", table).withColumn("_d", F.transform(point, lambda p: F.transform(
        p["stats"], lambda t: F.struct(
            t["c"].alias("c"), t["n"].alias("n"),
            (p["xx"] - 2 * F.aggregate(p["at"], F.lit(0.0), lambda s, e: s + e["v"] * F.get(t["s"], e["i"])) / t["n"]
             + t["q"] / t["n"]).alias("d"))))[0])
    pts = pts.select(
        F.filter("_d", lambda t: t["c"] == F.col("c"))[0].alias("_own"),
        F.array_min(F.transform(F.filter("_d", lambda t: t["c"] != F.col("c")),
                                lambda t: t["d"])).alias("_b"))
    own = F.col("_own")
    a = own["d"] * own["n"] / (own["n"] - 1)
    b = F.col("_b")
    s = F.when(own["n"] <= 1, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0)))
    return pts.select(s.alias("s")).agg(F.avg("s").alias("silhouette"))


def covariance(points: DataFrame, x: str = "x") -> DataFrame:
    """The sample covariance as rows (i, j, value), i <= j, of a column of arrays
    of equal length, from one aggregate over their non-zero coordinates: a point
    with n of them adds n (n + 1) / 2 products, combined before the shuffle.
    Coordinates that are zero throughout have no rows; points that are NULL are
    left out; under two points there is nothing."""
    v = _col(x)
    pts = points.where(v.isNotNull()).select(F.filter(
        F.transform(v, lambda c, i: F.struct(i.alias("i"), c.cast("double").alias("c"))),
        lambda e: e["c"] != 0).alias("e"))
    n = pts.agg(F.count(F.lit(1))).scalar()
    first = F.explode("e").alias("a")
    # (i, -1) rows hold the sums, (i, j) rows the products.
    terms = pts.select("e", first).select(
        F.col("a.i").alias("i"), F.col("a.c").alias("c"),
        F.explode(F.concat(F.array(F.struct(F.lit(-1).alias("i"), F.lit(1.0).alias("c"))),
                           F.filter("e", lambda e: e["i"] >= F.col("a.i")))).alias("b"))
    sums = terms.groupBy("i", F.col("b.i").alias("j")).agg(F.sum(F.col("c") * F.col("b.c")).alias("s"))
    sums = materialize(sums, "covariance-sums")  # d (d + 3) / 2 rows at most
    total = sums.where("j = -1").select("i", F.col("s").alias("t"))
    # Pairs that never meet have a covariance too: each sum beside the later ones.
    later = total.agg(F.collect_list(F.struct("i", "t"))).scalar()  # d of them
    pairs = total.withColumn("_all", later).select("i", F.col("t").alias("ti"), F.explode(
        F.filter("_all", lambda e: e["i"] >= F.col("i"))).alias("e")).select(
        "i", "ti", F.col("e.i").alias("j"), F.col("e.t").alias("tj"))
    found = pairs.join(sums.where("j >= 0"), ["i", "j"], "left").withColumn("_n", n)
    value = (F.coalesce("s", F.lit(0.0)) - F.col("ti") * F.col("tj") / F.col("_n")) / (F.col("_n") - 1)
    return found.where("_n > 1").select("i", "j", value.alias("value"))


def component_table(model: PCAModel, spark: SparkSession) -> DataFrame:
    """The principal components as rows (component, j, v): features times k."""
    pc = model.pc.toArray()
    return spark.createDataFrame([(c, j, float(pc[j, c])) for c in range(pc.shape[1]) for j in range(pc.shape[0])],
                                 "component int, j int, v double")


def eigen_faults(cov: DataFrame, components: DataFrame, tol: float = 1e-6) -> DataFrame:
    """C6, judged: per component (component, variance, residual, off) by the
    covariance table: the variance along it (its Rayleigh quotient), the length of
    C v - variance * v, and the greatest inner product with another component (its
    own length's distance from 1 included). Eigenvectors have residuals and
    offs of 0 up to ``tol`` of the largest variance: then ``fault`` is false. It is
    also true where a component's variance exceeds that of the one before."""
    whole = cov.select("i", "j", "value").unionAll(
        cov.where("i < j").select(F.col("j").alias("i"), F.col("i").alias("j"), "value"))
    image = (components.join(whole, "j").groupBy("component", "i").agg(F.sum(F.col("v") * F.col("value")).alias("cv"))
             .withColumnRenamed("i", "j"))
    both = components.join(image, ["component", "j"], "left").withColumn("cv", F.coalesce("cv", F.lit(0.0)))
    quotient = both.groupBy("component").agg(
        (F.sum(F.col("v") * F.col("cv")) / F.sum(F.col("v") * F.col("v"))).alias("variance"))
    residual = (both.join(quotient, "component").groupBy("component", "variance").agg(
        F.sqrt(F.sum(F.pow(F.col("cv") - F.col("variance") * F.col("v"), F.lit(2)))).alias("residual")))
    other = components.select(F.col("component").alias("o"), "j", F.col("v").alias("w"))
    inner = (components.join(other, "j").groupBy("component", "o").agg(F.sum(F.col("v") * F.col("w")).alias("p"))
             .groupBy("component").agg(F.max(F.abs(F.when(F.col("component") == F.col("o"), F.col("p") - 1)
                                                   .otherwise(F.col("p")))).alias("off")))
    out = residual.join(inner, "component")
    before = F.lag("variance").over(Window.orderBy("component"))  # one row a component
    top = out.agg(F.max("variance")).scalar()
    return out.withColumns({"_top": top, "_before": before}).select(
        "component", "variance", "residual", "off",
        ((F.col("residual") > tol * F.col("_top")) | (F.col("off") > tol)
         | F.coalesce(F.col("variance") > F.col("_before") + tol * F.col("_top"), F.lit(False))).alias("fault"))


def contingency(df: DataFrame, a: str | Column, b: str | Column) -> DataFrame:
    """(a, b, n): how many rows two clusterings put into each pair of clusters."""
    return df.groupBy(_col(a).alias("a"), _col(b).alias("b")).agg(F.count(F.lit(1)).alias("n"))


def adjusted_rand(df: DataFrame, a: str | Column, b: str | Column) -> DataFrame:
    """One row (rows, pairs_together, adjusted_rand): agreement of two
    clusterings, 1 for equal ones and about 0 for unrelated ones, from counts of
    row pairs that share clusters; no row pairs are made. NULL is a cluster of its
    own. Undefined (NULL) if either way no pair, or every pair, is together."""
    cells = materialize(contingency(df, a, b), "contingency")

    def pairs(c: str) -> Column:
        n = F.col(c).cast("double")
        return n * (n - 1) / 2

    def together(*by: str) -> DataFrame:
        return cells.groupBy(*by).agg(F.sum("n").alias("n")).agg(F.coalesce(F.sum(pairs("n")), F.lit(0.0)))

    out = cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                    F.coalesce(F.sum(pairs("n")), F.lit(0.0)).alias("pairs_together"))
    out = out.withColumns({"_a": together("a").scalar(), "_b": together("b").scalar()})
    chance = F.try_divide(F.col("_a") * F.col("_b"), pairs("rows"))
    index = F.try_divide(F.col("pairs_together") - chance, (F.col("_a") + F.col("_b")) / 2 - chance)
    return out.select("rows", F.col("pairs_together").cast("long").alias("pairs_together"),
                      index.alias("adjusted_rand"))


def pca_fit(df: DataFrame, k: int, features: str = "features",
            out: str = "pca_features") -> PCAModel:
    """PCA fit (covariance aggregated as a d x d matrix, d = #features)."""
    return PCA(k=k, inputCol=features, outputCol=out).fit(df)


def pca_reduce(df: DataFrame, k: int, features: str = "features",
               out: str = "pca_features") -> DataFrame:
    return pca_fit(df, k, features, out).transform(df)
