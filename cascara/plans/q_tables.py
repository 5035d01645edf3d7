"""Queries for projections, filters, aggregates, joins and B5/B6."""

from __future__ import annotations

from pyspark.sql import functions as F

from cascara.operators import tables as T
from cascara.plans import standins as S
from cascara.plans.registry import query, r6
from cascara.sources import load_table

TOP_TAG = "ring"
TOP_MIN_COUNT = 10


@query("top_rated", """
WITH s AS (
  SELECT l_partkey AS item_id, sum(l_quantity) AS rating_sum, count(*) AS rating_count
  FROM lineitem GROUP BY l_partkey HAVING count(*) > 10)
SELECT s.item_id, round(rating_sum / rating_count, 6) AS avg_rating,
       CAST(rating_count AS BIGINT) AS rating_count, p_name AS title
FROM s JOIN part ON part.p_partkey = s.item_id
WHERE list_contains(string_split(p_name, ' '), 'ring')
""")
def q_top_rated(spark, d):
    out = T.top_rated(S.ratings(spark, d), S.items_with_tags(spark, d), "item_id", "rating",
                      "title", F.col("tags"), TOP_TAG, TOP_MIN_COUNT)
    return out.withColumn("avg_rating", r6("avg_rating"))


@query("project_columns", """
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
""")
def q_project(spark, d):
    return T.project_columns(load_table(spark, d, "lineitem"), "l_orderkey", "l_partkey", "l_quantity")


@query("derive_column", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 6) AS revenue
FROM lineitem
""")
def q_derive(spark, d):
    li = load_table(spark, d, "lineitem")
    out = T.derive_column(li, "revenue", r6(F.col("l_extendedprice") * (1 - F.col("l_discount"))))
    return out.select("l_orderkey", "l_linenumber", "revenue")


@query("filter_compare", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45
""")
def q_filter_compare(spark, d):
    li = load_table(spark, d, "lineitem")
    return T.filter_all(li, F.col("l_quantity") > 45).select("l_orderkey", "l_linenumber", "l_quantity")


@query("filter_conjunction", """
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 25 AND l_discount < 0.05
""")
def q_filter_conj(spark, d):
    li = load_table(spark, d, "lineitem")
    return T.filter_all(li, F.col("l_quantity") > 25, F.col("l_discount") < 0.05).select(
        "l_orderkey", "l_linenumber")


@query("filter_array_contains", """
SELECT p_partkey AS item_id, p_name AS title FROM part
WHERE list_contains(string_split(p_name, ' '), 'ring')
""")
def q_filter_array(spark, d):
    it = S.items_with_tags(spark, d)
    return it.where(F.array_contains("tags", TOP_TAG)).select("item_id", "title")


@query("having_count", """
SELECT o_custkey, CAST(count(*) AS BIGINT) AS count FROM orders GROUP BY o_custkey HAVING count(*) > 10
""")
def q_having(spark, d):
    return T.having_count(load_table(spark, d, "orders"), "o_custkey", 10)


@query("group_count", """
SELECT event_type, CAST(count(*) AS BIGINT) AS count FROM events GROUP BY event_type
""")
def q_group_count(spark, d):
    return T.group_count(load_table(spark, d, "events"), "event_type")


@query("group_sum_count_avg", """
SELECT l_partkey AS item_id, round(sum(l_quantity), 6) AS value_sum,
       CAST(count(*) AS BIGINT) AS count, round(sum(l_quantity) / count(*), 6) AS value_avg
FROM lineitem GROUP BY l_partkey
""")
def q_sum_count_avg(spark, d):
    out = T.group_sum_count_avg(S.ratings(spark, d), "item_id", "rating")
    return out.select("item_id", r6("value_sum").alias("value_sum"), "count",
                      r6("value_avg").alias("value_avg"))


@query("count_if_many", """
SELECT CAST(count(*) AS BIGINT) AS rows,
       CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS BIGINT) AS returned,
       CAST(count(*) FILTER (WHERE l_quantity > 25) AS BIGINT) AS large_qty,
       CAST(count(*) FILTER (WHERE l_discount > 0.05) AS BIGINT) AS discounted
FROM lineitem
""")
def q_count_if_many(spark, d):
    li = load_table(spark, d, "lineitem")
    return T.count_if_many(li, {
        "returned": F.col("l_returnflag") == "R",
        "large_qty": F.col("l_quantity") > 25,
        "discounted": F.col("l_discount") > 0.05,
    })


HIST_EDGES = [0, 10, 20, 30, 40, 50]


@query("histogram_fixed", """
WITH b AS (SELECT * FROM (VALUES (0, 0.0, 10.0), (1, 10.0, 20.0), (2, 20.0, 30.0),
                                 (3, 30.0, 40.0), (4, 40.0, 50.0)) v(bin, lower, upper))
SELECT b.bin, CAST(b.lower AS DOUBLE) AS lower, CAST(b.upper AS DOUBLE) AS upper,
       CAST(count(l.l_quantity) AS BIGINT) AS count
FROM b LEFT JOIN lineitem l
  ON l.l_quantity >= b.lower AND (l.l_quantity < b.upper OR (b.bin = 4 AND l.l_quantity = b.upper))
GROUP BY b.bin, b.lower, b.upper
""")
def q_histogram(spark, d):
    return T.histogram_fixed(load_table(spark, d, "lineitem"), "l_quantity", HIST_EDGES)


@query("describe_numeric", """
SELECT * FROM (
  SELECT 'l_quantity' AS "column", CAST(count(l_quantity) AS BIGINT) AS count,
         round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS stddev,
         round(min(l_quantity), 6) AS min, round(max(l_quantity), 6) AS max FROM lineitem
  UNION ALL
  SELECT 'l_extendedprice', CAST(count(l_extendedprice) AS BIGINT), round(avg(l_extendedprice), 6),
         round(stddev_samp(l_extendedprice), 6), round(min(l_extendedprice), 6),
         round(max(l_extendedprice), 6) FROM lineitem
  UNION ALL
  SELECT 'l_discount', CAST(count(l_discount) AS BIGINT), round(avg(l_discount), 6),
         round(stddev_samp(l_discount), 6), round(min(l_discount), 6),
         round(max(l_discount), 6) FROM lineitem)
""")
def q_describe(spark, d):
    out = T.describe_numeric(load_table(spark, d, "lineitem"),
                             ["l_quantity", "l_extendedprice", "l_discount"])
    return out.select("column", "count", *[r6(c).alias(c) for c in ("mean", "stddev", "min", "max")])


_QUARTILES = ("l_quantity", "l_extendedprice", "l_discount", "l_orderkey")


@query("describe_quartiles", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 6) AS mean,
    CAST(quantile_disc({c}, 0.25) AS DOUBLE) AS q25, CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS q50,
    CAST(quantile_disc({c}, 0.75) AS DOUBLE) AS q75 FROM lineitem""" for c in _QUARTILES))
def q_describe_quartiles(spark, d):
    """A8 with exact percentiles."""
    out = T.describe_quartiles(load_table(spark, d, "lineitem"), _QUARTILES)
    return out.select("column", "count", r6("mean").alias("mean"), "q25", "q50", "q75")


@query("join_inner_dim", """
SELECT l_orderkey, l_linenumber, l_suppkey, s_name
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
""")
def q_join_inner(spark, d):
    li = load_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    sup = load_table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return T.join_inner(li, sup, "l_suppkey")


@query("tag_counts", """
SELECT tag, CAST(count(*) AS BIGINT) AS count
FROM (SELECT unnest(string_split(p_name, ' ')) AS tag FROM part) GROUP BY tag
""")
def q_tag_counts(spark, d):
    return T.tag_counts(S.items_with_tags(spark, d), F.col("tags"))


@query("split_to_array", """
SELECT p_partkey AS item_id, CAST(generate_subscripts(string_split(p_name, ' '), 1) - 1 AS INTEGER) AS pos,
       unnest(string_split(p_name, ' ')) AS tag
FROM part
""")
def q_split_to_array(spark, d):
    it = S.items_with_tags(spark, d)
    return it.select("item_id", F.posexplode("tags").alias("pos", "tag"))
