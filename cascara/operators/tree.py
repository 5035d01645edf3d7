"""Decision trees: fit, tuning and the tree as a table."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascara.operators.ranking import global_row_number
from cascara.operators.recommend import hash_split
from cascara.session import ensure_checkpoint_dir, materialize, scratch_path


def tree_pipeline(features: list[str], label: str = "label", max_depth: int = 5,
                  min_instances: int = 1, seed: int = 42, categorical: list[str] = (),
                  string_label: bool = False) -> Pipeline:
    """Index string columns, assemble, then a binary/multiclass tree.

    ``categorical`` names the string columns among ``features``: each is indexed
    (a value not seen in fitting, or NULL, gets an index of its own) and the
    tree splits on sets of its values. With ``string_label`` the label is
    indexed too and ``predicted_label`` holds the prediction as a string."""
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep")
              for c in categorical]
    stages.append(VectorAssembler(inputCols=[f"{c}_index" if c in categorical else c for c in features],
                                  outputCol="features"))
    if string_label:
        stages.append(StringIndexer(inputCol=label, outputCol=f"{label}_index", handleInvalid="skip"))
    stages.append(DecisionTreeClassifier(
        featuresCol="features", labelCol=f"{label}_index" if string_label else label,
        maxDepth=max_depth, minInstancesPerNode=min_instances, seed=seed, maxBins=256))
    return Pipeline(stages=stages)


def label_names(model: PipelineModel, label: str = "label") -> list[str]:
    """The strings behind the indexed label, by index."""
    return next(s.labels for s in model.stages
                if isinstance(s, StringIndexerModel) and s.getOutputCol() == f"{label}_index")


def tree_fit(df: DataFrame, features: list[str], label: str = "label", max_depth: int = 5,
             min_instances: int = 1, seed: int = 42) -> PipelineModel:
    return tree_pipeline(features, label, max_depth, min_instances, seed).fit(df)


def tree_tune(
    df: DataFrame, features: list[str], label: str = "label", depths=(2, 3, 5),
    min_instances=(1, 5, 20), seed: int = 42, parallelism: int = 4, key: str = "doc_id",
):
    """Hash split 80/20 on ``key``; every (depth, min instances) is fitted on
    the training part and scored (accuracy) on the validation part.

    Returns (best PipelineModel, metrics DataFrame with columns max_depth,
    min_instances, accuracy, leaves, is_best)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    train, val = (materialize(p, "tree-split") for p in hash_split(df, [key], (80, 20), seed))
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                           metricName="accuracy")

    def one(point):
        d, m = point
        model = tree_fit(train, features, label, d, m, seed)
        return point, model, ev.evaluate(model.transform(val))

    grid = list(product(depths, min_instances))
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = list(pool.map(one, grid))
    best = max(results, key=lambda x: (x[2], -x[0][0], -x[0][1]))
    rows = [(int(d), int(m), float(a), int(_leaves(model.stages[-1])), (d, m) == best[0])
            for (d, m), model, a in results]
    schema = "max_depth int, min_instances int, accuracy double, leaves int, is_best boolean"
    return best[1], spark.createDataFrame(rows, schema)


def stratified_folds(df: DataFrame, label: str = "label", key: str = "doc_id", folds: int = 5,
                     seed: int = 42, out: str = "fold") -> DataFrame:
    """``df`` plus a fold 0..folds-1 for each row. Rows are numbered by label,
    then by an md5 of seed and key, and dealt in turn: every class differs by one
    row at most between folds, and so does the whole. No class is sorted in one
    task. Rows with equal label and key are interchangeable; NULL is a class."""
    order = [F.col(label), F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"))), F.col(key)]
    numbered = global_row_number(df, order, "_no")
    return numbered.withColumn(out, ((F.col("_no") - 1) % folds).cast("int")).drop("_no")


def tree_cross_validate(
    df: DataFrame, features: list[str], label: str = "label", depths=(2, 3, 5),
    min_instances=(1, 5, 20), folds: int = 5, seed: int = 42, parallelism: int = 4, key: str = "doc_id",
) -> DataFrame:
    """D2 by cross-validation over :func:`stratified_folds`: (max_depth,
    min_instances, mean_accuracy, spread, error, scored, is_best) per grid point.

    ``spread`` is the sample standard deviation over the folds, ``error`` the
    standard error of the mean, ``scored`` the rows scored (each row once). The
    best point is the simplest (least depth, then most instances a node) whose
    mean is within one standard error of the highest mean. Rows without a label
    are left out."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    rows = materialize(stratified_folds(df.where(F.col(label).isNotNull()), label, key, folds, seed, "_fold"), "folds")

    def one(job):
        (depth, least), fold = job
        model = tree_fit(rows.where(F.col("_fold") != fold), features, label, depth, least, seed)
        got = model.transform(rows.where(F.col("_fold") == fold)).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction") == F.col(label)).alias("right")).first()
        return job[0], got["n"], got["right"]

    grid = list(product(depths, min_instances))
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        scored = list(pool.map(one, product(grid, range(folds))))
    found = []
    for point in grid:
        mine = [(n, right) for p, n, right in scored if p == point and n]
        shares = [right / n for n, right in mine]
        mean = sum(shares) / len(shares) if shares else None
        spread = (sum((s - mean) ** 2 for s in shares) / (len(shares) - 1)) ** 0.5 if len(shares) > 1 else 0.0
        found.append((*point, mean, spread, spread / max(1, len(shares)) ** 0.5, sum(n for n, _ in mine)))
    known = [r for r in found if r[2] is not None]
    top = max(known, key=lambda r: r[2], default=None)
    best = min((r for r in known if r[2] >= top[2] - top[4]), key=lambda r: (r[0], -r[1]), default=None)
    # One row per grid point, from distributed fits.
    return spark.createDataFrame(
        [(*r, r is best) for r in found],
        "max_depth int, min_instances int, mean_accuracy double, spread double, error double, scored bigint, "
        "is_best boolean")


def route(rows: DataFrame, nodes: DataFrame, features: list[str], depth: int,
          limit_bytes: int = 16 << 20) -> DataFrame:
    """D3: ``rows`` sent down a tree given as rows (:func:`tree_nodes`), a level at
    a time by joins: plus leaf (its node_id) and routed (the leaf's prediction).

    ``depth`` is the tree's. ``features`` name numeric columns, or index columns for
    category splits, in the order of the fit. A value above the threshold, NaN,
    NULL or outside the left categories goes right, as in the model. The node
    table is broadcast while its measured size allows (``limit_bytes``); a larger
    one is joined by shuffles, whose skew at the first levels AQE splits.
    """
    t = nodes.select(
        F.col("node_id").alias("_node"), F.col("left_child").alias("_left"), F.col("right_child").alias("_right"),
        F.col("feature").alias("_feature"), F.col("threshold").alias("_threshold"),
        F.col("left_categories").alias("_set"))
    size = t.agg(F.sum(40 + F.coalesce(F.octet_length("_feature"), F.lit(0)) + 8 * F.coalesce(
        F.size("_set"), F.lit(0)))).first()[0] or 0
    t = F.broadcast(t) if size <= limit_bytes else t
    value = F.element_at(F.create_map(*[x for c in features for x in (F.lit(c), F.col(c).cast("double"))]),
                         F.col("_feature"))
    left = F.when(F.col("_set").isNotNull(), F.array_contains("_set", value)).otherwise(
        (value <= F.col("_threshold")) & ~F.isnan(value))
    # The root has the least id; a literal would turn the first join into a loop.
    out = rows.withColumn("_node", nodes.agg(F.min("node_id")).scalar())
    for _ in range(depth):
        out = out.join(t, "_node").select(*rows.columns, F.when(F.col("_left").isNull(), F.col("_node")).when(
            F.coalesce(left, F.lit(False)), F.col("_left")).otherwise(F.col("_right")).alias("_node"))
    leaves = nodes.select(F.col("node_id").alias("_node"), F.col("prediction").alias("routed"))
    leaves = F.broadcast(leaves) if size <= limit_bytes else leaves
    return out.join(leaves, "_node").select(*rows.columns, F.col("_node").alias("leaf"), "routed")


def leaf_faults(routed: DataFrame, nodes: DataFrame, label: str = "label") -> DataFrame:
    """D3, judged by the training rows after :func:`route`: per leaf (node_id,
    rows, counts_off, not_majority): whether the rows' class counts differ from the
    node's, and whether its prediction is not a most frequent class of them."""
    found = routed.groupBy(F.col("leaf").alias("node_id"), F.col(label).cast("int").alias("_c")).agg(
        F.count(F.lit(1)).alias("_n"))
    told = nodes.where("is_prediction").select("node_id", "prediction", F.posexplode("class_counts").alias("_c", "_told"))
    both = told.join(found, ["node_id", "_c"], "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    mine = F.sum(F.when(F.col("_c") == F.col("prediction"), F.col("_n")))
    return both.groupBy("node_id").agg(
        F.sum("_n").alias("rows"), F.max(F.abs(F.col("_n") - F.col("_told")) > 1e-6).alias("counts_off"),
        (mine < F.max("_n")).alias("not_majority"))


def _leaves(tree: DecisionTreeClassificationModel) -> int:
    return (tree.numNodes + 1) // 2


def tree_nodes(model: PipelineModel | DecisionTreeClassificationModel,
               feature_names: list[str]) -> DataFrame:
    """D3: the fitted tree as rows, read back from the model's saved node
    table: node_id, type (root/left/right), name (node text), is_prediction,
    prediction, impurity, gain, left_child, right_child, feature, threshold
    (numeric splits), left_categories (category splits), class_counts. The model is written below the shared folder (the write is
    an action)."""
    tree = model.stages[-1] if isinstance(model, PipelineModel) else model
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "tree")
    tree.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    names = F.array(*[F.lit(n) for n in feature_names])
    is_leaf = F.col("leftChild") < 0
    feature = F.element_at(names, F.col("split.featureIndex") + 1)
    # A split on a category lists the indices that go left; numCategories is -1
    # for a numeric feature, whose only value is the threshold.
    numeric = F.col("split.numCategories") < 0
    left = F.col("split.leftCategoriesOrThreshold")
    threshold = F.when(numeric, left[0])
    stats = F.array_join(F.transform("impurityStats", lambda x: x.cast("string")), ", ")
    # Node text formats of the exported tree, "<feature> <= <t>"
    # for a split and "<prediction>: ([<n0>, <n1>])" for a leaf.
    name = F.when(is_leaf, F.concat(F.col("prediction").cast("string"), F.lit(": (["), stats,
                                    F.lit("])")))
    name = name.when(numeric, F.concat(feature, F.lit(" <= "), threshold.cast("string")))
    name = name.otherwise(F.concat(feature, F.lit(" in {"), F.array_join(
        F.transform(left, lambda x: x.cast("int").cast("string")), ", "), F.lit("}")))
    # Position of every node under its parent (the tree has 2^depth nodes at most).
    inner = nodes.where(~is_leaf)
    sides = inner.select(F.col("leftChild").alias("id"), F.lit("left").alias("type")).unionByName(
        inner.select(F.col("rightChild").alias("id"), F.lit("right").alias("type")))
    placed = nodes.join(sides, "id", "left")
    return placed.select(
        F.col("id").alias("node_id"),
        F.coalesce("type", F.lit("root")).alias("type"),
        name.alias("name"),
        is_leaf.alias("is_prediction"),
        F.col("prediction"),
        F.col("impurity"),
        F.when(is_leaf, None).otherwise(F.col("gain")).alias("gain"),
        F.when(is_leaf, None).otherwise(F.col("leftChild")).alias("left_child"),
        F.when(is_leaf, None).otherwise(F.col("rightChild")).alias("right_child"),
        F.when(is_leaf, None).otherwise(feature).alias("feature"),
        F.when(is_leaf, None).otherwise(threshold).alias("threshold"),
        F.when(~is_leaf & ~numeric, left).alias("left_categories"),
        F.col("impurityStats").alias("class_counts"),
    )
