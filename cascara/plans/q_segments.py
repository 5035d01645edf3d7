"""Queries for set-size segmentation and one-hot features (SG1-SG2, A5,
A10, E1-E3). Rows: per part the distinct suppliers of its line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from cascara.functions import split_on
from cascara.operators import features as E
from cascara.operators import segments as G
from cascara.plans import standins as S
from cascara.plans.registry import query
from cascara.session import materialize

# Fixed value: the number of most common items that become features.
TOP_K = 100
ONE_HOT_PREFIX = "s_"


def profiles(spark, d):
    return S.part_profiles(spark, d).withColumn("items", split_on("items_str", "-"))


def profiles_once(spark, d):
    """The derived profile table for queries that read it in two passes
    (top-k names, then features): written once, like an input file."""
    return materialize(profiles(spark, d), "profiles")


_PROF = """
WITH pr AS (
  SELECT l_partkey AS id, CAST(count(DISTINCT l_suppkey) AS INTEGER) AS numports,
         string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), '-'
                    ORDER BY CAST(l_suppkey AS VARCHAR)) AS items_str
  FROM lineitem GROUP BY l_partkey),
prof AS (SELECT pr.*, p_type = 'PROMO' AS flag FROM pr JOIN part ON p_partkey = pr.id),
sz AS (SELECT numports AS size, count(*) AS c FROM prof WHERE numports > 1 GROUP BY numports),
cut AS (SELECT coalesce(max(size) FILTER (WHERE c > 1), 1) AS cutoff FROM sz),
nem AS (SELECT * FROM prof WHERE numports > 1 AND numports <= (SELECT cutoff FROM cut)),
nocc AS (SELECT id, unnest(list_distinct(string_split(items_str, '-'))) AS item FROM nem),
top AS (SELECT item, count(*) AS c FROM nocc GROUP BY item ORDER BY c DESC, item LIMIT 100),
topr AS (SELECT item, c, row_number() OVER (ORDER BY c DESC, item) AS rk FROM top)
"""


@query("rows_by_set_size", _PROF + "SELECT size, CAST(c AS BIGINT) AS count FROM sz")
def q_rows_by_size(spark, d):
    return G.rows_by_set_size(S.part_sizes(spark, d), "numports")


@query("non_rare_max", _PROF + "SELECT max(size) FILTER (WHERE c > 1) AS max_non_rare FROM sz")
def q_non_rare_max(spark, d):
    return G.non_rare_max(S.part_sizes(spark, d), "numports")


@query("segment_rows", _PROF + """
SELECT id, numports, CASE WHEN numports = 1 THEN 'single'
                          WHEN numports > (SELECT cutoff FROM cut) THEN 'extreme'
                          WHEN numports > 1 THEN 'multi' ELSE 'other' END AS segment
FROM prof""")
def q_segment_rows(spark, d):
    return G.segment_rows(materialize(S.part_sizes(spark, d), "sizes"), "numports").select("id", "numports", "segment")


@query("extreme_rows", _PROF + """
SELECT id, numports, items_str, flag FROM prof WHERE numports > (SELECT cutoff FROM cut)""")
def q_extreme_rows(spark, d):
    return G.extreme_rows(profiles_once(spark, d), "numports").select("id", "numports", "items_str", "flag")


@query("top_k_items", _PROF + "SELECT item, CAST(c AS BIGINT) AS count, CAST(rk AS INTEGER) AS rank FROM topr")
def q_top_k(spark, d):
    pop = G.non_extreme_multi(profiles_once(spark, d), "numports")
    return E.top_k_items(pop, "items", TOP_K)


_ONE_HOT_SQL = _PROF + "SELECT id, " + ", ".join(
    f"list_contains(string_split(items_str, '-'), (SELECT item FROM topr WHERE rk = {i})) "
    f"AS {ONE_HOT_PREFIX}{i}" for i in range(1, TOP_K + 1)) + " FROM nem"


@query("one_hot_items", _ONE_HOT_SQL)
def q_one_hot(spark, d):
    pop = G.non_extreme_multi(profiles_once(spark, d), "numports")
    names = E.top_k_names(pop, "items", TOP_K)
    # Fewer than k distinct items: the missing ranks become NULL columns, as
    # in the SQL form, so the result always has k feature columns.
    names = names + [None] * (TOP_K - len(names))
    oh = E.one_hot_items(pop, "items", names, ONE_HOT_PREFIX, name_by="rank")
    return oh.select("id", *[f"{ONE_HOT_PREFIX}{i}" for i in range(1, TOP_K + 1)])


@query("one_hot_check", _PROF + """
SELECT CAST(rk AS INTEGER) AS rank, item, CAST(c AS BIGINT) AS true_count,
       CAST(c AS BIGINT) AS item_count FROM topr""")
def q_one_hot_check(spark, d):
    pop = G.non_extreme_multi(profiles_once(spark, d), "numports")
    names = E.top_k_names(pop, "items", TOP_K)
    oh = E.one_hot_items(pop, "items", names, ONE_HOT_PREFIX, name_by="rank")
    return E.one_hot_check(oh, pop, "items", names, ONE_HOT_PREFIX, name_by="rank")


@query("filter_boolean", _PROF + "SELECT id, numports FROM prof WHERE flag")
def q_filter_boolean(spark, d):
    from cascara.operators import tables as T

    return T.filter_all(S.part_sizes(spark, d), F.col("flag")).select("id", "numports")


@query("one_hot_vector", _PROF + """
SELECT n.id, CAST(count(t.item) AS INTEGER) AS hot_count,
       CAST(coalesce(sum(t.rk - 1), 0) AS INTEGER) AS index_sum
FROM nem n LEFT JOIN topr t ON list_contains(string_split(n.items_str, '-'), t.item)
GROUP BY n.id
""")
def q_one_hot_vector(spark, d):
    """E2 as a sparse vector; checked through its non-zero count and the sum
    of its non-zero indices."""
    from pyspark.ml.functions import vector_to_array

    pop = G.non_extreme_multi(profiles_once(spark, d), "numports")
    names = E.top_k_names(pop, "items", TOP_K)
    vec = E.one_hot_vector(pop, "items", names, "v").select("id", vector_to_array("v").alias("a"))
    idx = F.transform(F.sequence(F.lit(0), F.size("a") - 1),
                      lambda i: F.when(F.col("a")[i] > 0, i).otherwise(0))
    return vec.select(
        "id",
        F.size(F.filter("a", lambda x: x > 0)).alias("hot_count"),
        F.aggregate(idx, F.lit(0), lambda acc, x: acc + x).alias("index_sum"),
    )
