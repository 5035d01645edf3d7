"""Relational operators over tables: projections, filters, grouped
aggregates, joins, histograms and summaries (P1-P2, F1-F9, J1, A2-A9, B5-B6).

All aggregates are authored as ONE ``agg`` per grouping so a table is scanned
and shuffled once (the sum/count self-join in the reference scans twice).
"""

from __future__ import annotations

import math
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascara.functions import ratio


# --- projections and filters ------------------------------------------------

def project_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Only the named columns reach the scan's ReadSchema."""
    return df.select(*cols)


def derive_column(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """P2."""
    return df.withColumn(name, expr)


def filter_all(df: DataFrame, *preds: Column) -> DataFrame:
    """F1/F2/F8: chained predicates; Catalyst merges them into one Filter and
    pushes the comparable parts into the parquet scan."""
    for p in preds:
        df = df.where(p)
    return df


def having_count(df: DataFrame, key: str | Sequence[str], threshold: int) -> DataFrame:
    """groups whose row count is strictly above ``threshold``."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > threshold)


# --- aggregates ----------------------------------------------------------------

def group_count(df: DataFrame, key: str | Sequence[str], sort: bool = True) -> DataFrame:
    """A2: rows per group, largest first."""
    keys = [key] if isinstance(key, str) else list(key)
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy(F.desc("count"), *keys) if sort else out


def group_sum_count_avg(df: DataFrame, key: str, value: str) -> DataFrame:
    """A3 + A4: per key the sum of ``value``, the row count and sum/count, in
    one aggregate (the average divides by all rows, as the reference does)."""
    return df.groupBy(key).agg(
        F.sum(F.col(value).cast("double")).alias("value_sum"),
        F.count(F.lit(1)).alias("count"),
    ).withColumn("value_avg", ratio("value_sum", "count"))


def count_if_many(df: DataFrame, preds: dict[str, Column]) -> DataFrame:
    """Row count plus one count per named predicate, in a single pass
    (the reference runs one job per count)."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(p).alias(name) for name, p in preds.items()]
    return df.agg(*aggs)


def share(df: DataFrame, pred: Column, alias: str = "share") -> DataFrame:
    """Fraction of rows for which ``pred`` holds (NULL counts as false)."""
    return df.agg(F.avg(F.coalesce(pred, F.lit(False)).cast("double")).alias(alias))


def histogram_fixed(df: DataFrame, col: str, edges: Sequence[float]) -> DataFrame:
    """A7 with ``RDD.histogram`` semantics: bins ``[e_i, e_i+1)``, the last one
    closed, values outside or NULL/NaN ignored, empty bins reported as 0.

    One global aggregate with a ``count_if`` per bin, then unpivoted: a single
    pass and no join against a bin table.
    """
    e = [float(x) for x in edges]
    if len(e) < 2 or any(a >= b for a, b in zip(e, e[1:])):
        raise ValueError("edges must be strictly increasing and at least two")
    v = F.col(col).cast("double")
    n = len(e) - 1
    aggs = []
    for i in range(n):
        upper_ok = (v <= e[i + 1]) if i == n - 1 else (v < e[i + 1])
        aggs.append(F.count_if((v >= e[i]) & upper_ok & ~F.isnan(v)).alias(f"b{i}"))
    wide = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(i).alias("bin"), F.lit(e[i]).alias("lower"),
                 F.lit(e[i + 1]).alias("upper"), F.col(f"b{i}").alias("count"))
        for i in range(n)
    ])
    return wide.select(F.inline(rows))


def describe_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Count, mean, sample stddev, min, max per column, one row per column
    (one scan; the wide result is unpivoted)."""
    cols = list(cols)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__sd"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__n").alias("count"),
                 F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__sd").alias("stddev"),
                 F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"))
        for c in cols
    ])
    return wide.select(F.inline(rows))


def exact_quantiles(df: DataFrame, cols: Iterable[str], probabilities=(0.25, 0.5, 0.75),
                    accuracy: int = 10_000, few: int = 50_000) -> DataFrame:
    """A8 with percentiles: (column, probability, value), the value being the exact
    discrete quantile: the ceil(p * n)-th least of n values, NULLs left out, NaN
    last. NULL without values.

    No column is sorted. A mergeable sketch (``percentile_approx``) gives each
    quantile a bracket, one exact recount says how many values lie below and
    inside, and the next sketch looks inside only; brackets shrink by about
    ``accuracy`` / 3 a round. Where the recount shows that a sketch missed, the
    bracket is what lies beside it. Brackets of at most ``few`` distinct values are
    counted by value. All columns and probabilities share each pass.
    """
    spark, cols = df.sparkSession, list(cols)
    data = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(cols)])
    sizes = data.agg(*[F.count(c).alias(c) for c in data.columns]).first()
    # (column, probability) -> rank wanted, bracket, values below it and inside it.
    jobs = {(i, p): {"rank": max(1, math.ceil(p * sizes[f"_{i}"])), "lo": -math.inf, "hi": math.nan,
                     "below": 0, "n": sizes[f"_{i}"]}
            for i in range(len(cols)) for p in probabilities if sizes[f"_{i}"]}

    def within(i: int, lo: float, hi: float) -> Column:  # NaN is the greatest
        return (F.col(f"_{i}") >= F.lit(lo)) & (F.col(f"_{i}") <= F.lit(hi))

    values: dict[tuple, float] = {}
    while keys := [k for k in jobs if k not in values]:
        ask = []
        for k in keys:
            job, e = jobs[k], 1.5 / accuracy
            at = (job["rank"] - job["below"]) / job["n"]
            ask.append(F.percentile_approx(
                F.when(within(k[0], job["lo"], job["hi"]), F.col(f"_{k[0]}")),
                F.array(F.lit(max(0.0, at - e)), F.lit(min(1.0, at + e))), accuracy))
        edges = dict(zip(keys, data.agg(*ask).first()))
        ask = []
        for (i, _), (a, b) in edges.items():
            x, here = F.col(f"_{i}"), within(i, a, b)
            ask.append(F.struct(
                F.count_if(x < F.lit(a)).alias("below"), F.count_if(here).alias("n"),
                F.count_if(x == F.lit(a)).alias("at_a"), F.count_if(x == F.lit(b)).alias("at_b"),
                F.approx_count_distinct(F.when(here, x)).alias("distinct")))
        for k, got in zip(keys, data.agg(*ask).first()):
            job, (a, b) = jobs[k], edges[k]
            old, few_left = (job["lo"], job["hi"]), False
            if job["rank"] <= got["below"]:
                job.update(hi=a, n=got["below"] - job["below"] + got["at_a"])
            elif job["rank"] > got["below"] + got["n"]:
                below = got["below"] + got["n"] - got["at_b"]
                job.update(lo=b, n=job["n"] - (below - job["below"]), below=below)
            else:
                job.update(lo=a, hi=b, below=got["below"], n=got["n"])
                few_left = got["distinct"] <= few
            if a == b or (a != a and b != b):
                if got["below"] < job["rank"] <= got["below"] + got["n"]:
                    values[k] = a
            if k not in values and (few_left or (job["lo"], job["hi"]) == old):
                counted = data.where(within(k[0], job["lo"], job["hi"])).groupBy(f"_{k[0]}").agg(F.count(F.lit(1)))
                rank = job["rank"] - job["below"]
                for value, n in sorted(map(tuple, counted.collect()), key=lambda r: (r[0] != r[0], r[0])):
                    rank -= n
                    if rank <= 0:
                        values[k] = value
                        break
    rows = [(c, float(p), values.get((i, p))) for i, c in enumerate(cols) for p in probabilities]
    return spark.createDataFrame(rows, "column string, probability double, value double")


def describe_quartiles(df: DataFrame, cols: Iterable[str], **options) -> DataFrame:
    """A8 in full: :func:`describe_numeric` plus q25, q50 and q75."""
    cols = list(cols)
    q = (exact_quantiles(df, cols, **options).groupBy("column").pivot("probability", [0.25, 0.5, 0.75])
         .agg(F.first("value")).toDF("column", "q25", "q50", "q75"))
    return describe_numeric(df, cols).join(q, "column")


# --- composite jobs ------------------------------------------------------------

def tag_counts(items: DataFrame, tags: Column, sort: bool = True) -> DataFrame:
    """Split tag lists, flatten, count (NULL lists contribute nothing)."""
    out = (items.select(F.explode(tags).alias("tag"))
           .groupBy("tag").agg(F.count(F.lit(1)).alias("count")))
    return out.orderBy(F.desc("count"), "tag") if sort else out


def top_rated(
    ratings: DataFrame,
    items: DataFrame,
    item_col: str,
    rating_col: str,
    title_col: str,
    tags: Column,
    tag: str,
    min_count: int,
    sort: bool = True,
    broadcast_bytes: int = 16 << 20,
) -> DataFrame:
    """Items carrying ``tag`` with more than ``min_count`` ratings, by
    average rating (highest first).

    Plan: the dimension is filtered on the tag and the bytes of its matching
    ids and titles are summed (one small action). Up to ``broadcast_bytes``,
    the ratings are semi-joined to a broadcast of them *before* aggregating, so only
    ratings of tagged items are aggregated and shuffled. Beyond that, the
    fact side is aggregated first (partial + final aggregate, one row per
    item leaves the shuffle) and joined afterwards, with the join strategy
    left to AQE. The HAVING test sits below the join in both cases.
    """
    chosen = items.where(F.array_contains(tags, tag)).select(
        F.col(item_col).alias("item_id"), F.col(title_col).alias("title"))
    # 40 bytes a row for ids, lengths and the row itself.
    size = chosen.agg(F.sum(40 + F.coalesce(F.octet_length(F.col("title").cast("string")),
                                            F.lit(0)))).first()[0] or 0
    facts = ratings.select(F.col(item_col).alias("item_id"), F.col(rating_col).alias("_r"))
    if size <= broadcast_bytes:
        facts = facts.join(F.broadcast(chosen.select("item_id")), "item_id", "left_semi")
    stats = facts.groupBy("item_id").agg(
        F.sum(F.col("_r").cast("double")).alias("rating_sum"),
        F.count(F.lit(1)).alias("rating_count"),
    ).where(F.col("rating_count") > min_count)
    dim = F.broadcast(chosen) if size <= broadcast_bytes else chosen
    out = stats.join(dim, "item_id", "inner").select(
        "item_id",
        ratio("rating_sum", "rating_count").alias("avg_rating"),
        "rating_count",
        "title",
    )
    return out.orderBy(F.desc("avg_rating"), "item_id") if sort else out


def join_inner(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Inner equi-join on a shared column name (strategy left to AQE)."""
    return fact.join(dim, key, "inner")
