"""Queries for item popularity and frequent item-set mining (I1-I6, W1, F6,
F7, A9). Baskets: per order the distinct part brands. Thresholds are shares
of the basket count, so they scale with the data."""

from __future__ import annotations

from pyspark.sql import functions as F

from cascara.operators import itemsets as I
from cascara.operators import tables as T
from cascara.plans import standins as S
from cascara.plans.registry import query, r6
from cascara.session import materialize, scratch_path
from cascara.sources import load_table

ITEM_SHARE = 0.12    # item frequent when in more than 12 % of baskets
SET_SHARE = 0.004    # set frequent when in more than 0.4 % of baskets
WANTED = ["Brand#4", "Brand#19"]


def _baskets(spark, d):
    return S.brand_sets(spark, d)


def _baskets_once(spark, d):
    """The derived baskets play the role of the reference's input file: they
    are written once and scanned by every pass; counting them is free then."""
    b = materialize(_baskets(spark, d), "baskets")
    n = b.count()
    return b, ITEM_SHARE * n, SET_SHARE * n


_BASE = f"""
WITH bk AS (
  SELECT l_orderkey AS basket_id, string_agg(DISTINCT p_brand, '-' ORDER BY p_brand) AS items_str
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey),
occ AS (SELECT basket_id, unnest(list_distinct(string_split(items_str, '-'))) AS item FROM bk),
nb AS (SELECT count(*) AS n FROM bk),
ic AS (SELECT item, count(*) AS c FROM occ GROUP BY item),
fi AS (SELECT item, c, row_number() OVER (ORDER BY c DESC, item) AS rk FROM ic
       WHERE c > CAST({ITEM_SHARE} AS DOUBLE) * (SELECT n FROM nb)),
fo AS (SELECT basket_id, item, rk FROM occ JOIN fi USING (item)),
p2 AS (SELECT a.item || '-' || b.item AS label, count(*) AS c
       FROM fo a JOIN fo b ON a.basket_id = b.basket_id AND a.rk < b.rk
       GROUP BY a.item, b.item HAVING count(*) > CAST({SET_SHARE} AS DOUBLE) * (SELECT n FROM nb)),
p3 AS (SELECT a.item || '-' || b.item || '-' || c.item AS label, count(*) AS c
       FROM fo a JOIN fo b ON a.basket_id = b.basket_id AND a.rk < b.rk
                 JOIN fo c ON c.basket_id = a.basket_id AND b.rk < c.rk
       GROUP BY a.item, b.item, c.item
       HAVING count(*) > CAST({SET_SHARE} AS DOUBLE) * (SELECT n FROM nb)),
p4 AS (SELECT a.item || '-' || b.item || '-' || c.item || '-' || e.item AS label, count(*) AS c
       FROM fo a JOIN fo b ON a.basket_id = b.basket_id AND a.rk < b.rk
                 JOIN fo c ON c.basket_id = a.basket_id AND b.rk < c.rk
                 JOIN fo e ON e.basket_id = a.basket_id AND c.rk < e.rk
       GROUP BY a.item, b.item, c.item, e.item
       HAVING count(*) > CAST({SET_SHARE} AS DOUBLE) * (SELECT n FROM nb))
"""


@query("item_counts", _BASE + "SELECT item, CAST(c AS BIGINT) AS count FROM ic")
def q_item_counts(spark, d):
    return I.item_counts(_baskets(spark, d), "items")


@query("frequent_items", _BASE + "SELECT item, CAST(c AS BIGINT) AS count FROM fi")
def q_frequent_items(spark, d):
    b, t_item, _ = _baskets_once(spark, d)
    return I.frequent_items(I.item_counts(b, "items", sort=False), t_item)


@query("item_rank", _BASE + "SELECT item, CAST(c AS BIGINT) AS count, CAST(rk AS BIGINT) AS rank FROM fi")
def q_item_rank(spark, d):
    b, t_item, _ = _baskets_once(spark, d)
    return I.rank_items(I.frequent_items(I.item_counts(b, "items", sort=False), t_item))


@query("filter_contains_all", f"""
WITH bk AS (
  SELECT l_orderkey, list_distinct(list(p_brand)) AS items
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey)
SELECT CAST(count(*) FILTER (WHERE len(items) >= 2 AND list_contains(items, '{WANTED[0]}')
                             AND list_contains(items, '{WANTED[1]}')) AS BIGINT) AS count FROM bk
""")
def q_contains_all(spark, d):
    return I.count_containing_all(_baskets(spark, d), "items", WANTED)


@query("filter_set_size", """
WITH bk AS (
  SELECT l_orderkey AS basket_id, count(DISTINCT p_brand) AS n_items
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey)
SELECT basket_id, CAST(n_items AS INTEGER) AS n_items FROM bk WHERE n_items >= 2
""")
def q_set_size(spark, d):
    b = I.baskets_of_size(_baskets(spark, d), "items", 2)
    return b.select("basket_id", F.size("items").alias("n_items"))


@query("share_multi", """
WITH bk AS (
  SELECT l_orderkey AS basket_id, count(DISTINCT p_brand) AS n_items
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey)
SELECT round(avg(CASE WHEN n_items >= 2 THEN 1.0 ELSE 0.0 END), 6) AS share FROM bk
""")
def q_share_multi(spark, d):
    out = T.share(_baskets(spark, d), F.size("items") >= 2)
    return out.select(r6("share").alias("share"))


def _mined(spark, d, min_len, max_len):
    b, t_item, t_set = _baskets_once(spark, d)
    out = I.frequent_itemsets(b, "items", t_item, t_set, max_len=max_len, min_len=min_len,
                              key="basket_id")
    return out.select("level", "label", "count")


@query("frequent_pairs", _BASE + "SELECT 2 AS level, label, CAST(c AS BIGINT) AS count FROM p2")
def q_pairs(spark, d):
    return _mined(spark, d, 2, 2)


@query("frequent_triples", _BASE + "SELECT 3 AS level, label, CAST(c AS BIGINT) AS count FROM p3")
def q_triples(spark, d):
    return _mined(spark, d, 3, 3)


_ALL = _BASE + """
SELECT 2 AS level, label, CAST(c AS BIGINT) AS count FROM p2
UNION ALL SELECT 3, label, CAST(c AS BIGINT) FROM p3
UNION ALL SELECT 4, label, CAST(c AS BIGINT) FROM p4
"""


@query("frequent_itemsets", _ALL)
def q_itemsets(spark, d):
    return _mined(spark, d, 2, 4)


@query("frequent_triples_staged", _BASE + """
SELECT 2 AS level, label, CAST(c AS BIGINT) AS count FROM p2
UNION ALL SELECT 3, label, CAST(c AS BIGINT) FROM p3""")
def q_triples_staged(spark, d):
    """I5 from a saved level: pairs are mined and written, triples go on from
    the file."""
    b, t_item, t_set = _baskets_once(spark, d)
    path = scratch_path(spark, "pairs")
    I.frequent_itemsets(b, "items", t_item, t_set, max_len=2, key="basket_id").write.parquet(path)
    out = I.frequent_itemsets(b, "items", t_item, t_set, max_len=3, key="basket_id",
                              start=spark.read.parquet(path))
    return out.select("level", "label", "count")


@query("frequent_itemsets_fp", _ALL)
def q_itemsets_fp(spark, d):
    b, t_item, t_set = _baskets_once(spark, d)
    out = I.frequent_itemsets_fpgrowth(b, "items", t_item, t_set, max_len=4, key="basket_id")
    return out.select("level", "label", "count")


@query("given_sets", _BASE + """
, b AS (SELECT DISTINCT p_brand AS item FROM part),
w AS (SELECT a.item AS x, c.item AS y, NULL AS z FROM b a JOIN b c ON a.item < c.item
      UNION ALL SELECT a.item, c.item, e.item FROM b a JOIN b c ON a.item < c.item JOIN b e ON c.item < e.item),
h AS (SELECT x, y, NULL AS z, count(*) AS n FROM (
        SELECT a.item AS x, c.item AS y FROM occ a JOIN occ c ON a.basket_id = c.basket_id AND a.item < c.item)
      GROUP BY x, y
      UNION ALL SELECT x, y, z, count(*) FROM (
        SELECT a.item AS x, c.item AS y, e.item AS z FROM occ a JOIN occ c ON a.basket_id = c.basket_id AND a.item < c.item
        JOIN occ e ON e.basket_id = a.basket_id AND c.item < e.item) GROUP BY x, y, z)
SELECT concat_ws('-', w.x, w.y, w.z) AS label, coalesce(h.n, 0)::BIGINT AS count
FROM w LEFT JOIN h ON w.x = h.x AND w.y = h.y AND w.z IS NOT DISTINCT FROM h.z
""")
def q_given_sets(spark, d):
    """I3 for thousands of given sets in one pass: all pairs and triples of brands,
    found in an order or not."""
    brands = load_table(spark, d, "part").agg(F.array_sort(F.collect_set("p_brand")).alias("b"))  # 25 names

    def longer(df, at: str, names: list[str]):
        """Each row once for every brand after position ``at``."""
        rest = F.transform(F.slice("b", F.col(at) + 2, F.size("b")), lambda x, i: F.struct(
            (F.col(at) + 1 + i).alias("at"), x.alias("x")))
        return df.withColumn("e", F.explode(rest)).select(
            "b", F.col("e.at").alias("at"), *names, F.col("e.x").alias(f"x{len(names)}"))

    one = brands.select("b", F.posexplode("b").alias("at", "x0"))
    two = longer(one, "at", ["x0"])
    three = longer(two, "at", ["x0", "x1"])
    wanted = two.select(F.array("x0", "x1").alias("items")).unionAll(three.select(F.array("x0", "x1", "x2")))
    return I.count_given_sets(_baskets(spark, d), "items", wanted).select(
        F.concat_ws("-", "items").alias("label"), "count")
