import math

import pytest
from pyspark.sql import functions as F

from cascara.operators import tables as T


def _py_histogram(values, edges):
    counts = [0] * (len(edges) - 1)
    for v in values:
        if v is None or (isinstance(v, float) and math.isnan(v)):
            continue
        if v < edges[0] or v > edges[-1]:
            continue
        for i in range(len(edges) - 1):
            last = i == len(edges) - 2
            if edges[i] <= v and (v < edges[i + 1] or (last and v == edges[i + 1])):
                counts[i] += 1
                break
    return counts


def test_histogram_fixed_semantics(spark):
    vals = [0.0, 0.5, 1.0, 5.0, 6.0, 6.5, -1.0, None, float("nan"), 3.999, 2.0]
    edges = [0, 1, 2, 3, 4, 5, 6]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r["count"] for r in T.histogram_fixed(df, "x", edges).orderBy("bin").collect()]
    assert got == _py_histogram(vals, edges)
    assert got[4] == 0  # empty bin reported


def test_histogram_rejects_bad_edges(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError):
        T.histogram_fixed(df, "x", [1, 1])


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_top_rated_literal(spark, broadcast_bytes):
    ratings = spark.createDataFrame(
        [(1, 5.0), (1, 4.0), (1, 3.0), (2, 5.0), (2, 5.0), (2, 5.0), (3, 1.0), (3, 2.0), (3, 3.0),
         (4, 5.0)], "item_id int, rating double")
    items = spark.createDataFrame(
        [(1, "A", "Comedy|Drama"), (2, "B", "Drama"), (3, "C", "Comedy"), (4, "D", "Comedy"),
         (5, "E", None)], "item_id int, title string, genres string")
    from cascara.functions import split_on
    out = T.top_rated(ratings, items, "item_id", "rating", "title", split_on("genres", "|"),
                      "Comedy", 2, broadcast_bytes=broadcast_bytes).collect()
    assert [(r["item_id"], r["avg_rating"], r["rating_count"]) for r in out] == [(1, 4.0, 3), (3, 2.0, 3)]


def test_single_aggregate_equals_two_aggregates_and_join(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (2, 3.0)], "k int, v double")
    one = {r["k"]: (r["value_sum"], r["count"], r["value_avg"])
           for r in T.group_sum_count_avg(df, "k", "v").collect()}
    s = df.groupBy("k").sum("v")
    c = df.groupBy("k").count()
    two = {r["k"]: (r["sum(v)"], r["count"], r["sum(v)"] / r["count"])
           for r in s.join(c, "k").collect()}
    assert one == two


def test_conjunction_equals_chain(spark):
    df = spark.range(100).withColumn("y", F.col("id") % 7)
    a = T.filter_all(df, F.col("id") > 10, F.col("y") == 3).count()
    b = df.where((F.col("id") > 10) & (F.col("y") == 3)).count()
    assert a == b > 0


def test_describe_and_count_if(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    r = T.describe_numeric(df, ["x"]).first()
    assert (r["count"], r["mean"], r["stddev"], r["min"], r["max"]) == (3, 2.0, 1.0, 1.0, 3.0)
    c = T.count_if_many(df, {"big": F.col("x") > 1}).first()
    assert (c["rows"], c["big"]) == (4, 2)
    s = T.share(df, F.col("x") > 1).first()["share"]
    assert s == 0.5
