import random

import pytest
from pyspark.sql import functions as F

from cascara.operators import itemsets as I


def brute(baskets, sets, min_size=1):
    clean = [{x for x in b or [] if x is not None} for b in baskets]
    out = []
    for s in sets:
        if s is None:
            out.append(None)
        else:
            want = {x for x in s if x is not None}
            out.append(sum(want <= b for b in clean if len(b) >= min_size))
    return out


def run(spark, baskets, sets, kind="string", **options):
    b = spark.createDataFrame([(x,) for x in baskets], f"items array<{kind}>").repartition(4)
    w = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], f"id int, wanted array<{kind}>")
    out = I.count_given_sets(b, "items", w, "wanted", **options)
    assert out.columns == ["id", "wanted", "count"]
    return [r["count"] for r in out.orderBy("id").collect()]


@pytest.mark.parametrize("seed, min_size", [(1, 1), (2, 2), (3, 0)])
def test_random_sets(spark, seed, min_size):
    rng = random.Random(seed)
    items = list("abcdefghijkl")
    baskets = [rng.sample(items, rng.randint(0, 7)) for _ in range(300)]
    sets = [rng.sample(items, rng.randint(1, 5)) for _ in range(400)]
    assert run(spark, baskets, sets, min_size=min_size) == brute(baskets, sets, min_size)


def test_edge_cases(spark):
    baskets = [["a", "b", "b", None], None, [], ["c"], ["a", "c", "x"], [None]]
    sets = [[], None, ["a"], ["a", "a"], [None, "a"], ["b", "a"], ["zz"], ["a", "zz"], ["a", "c"], ["a", "c"], ["x", "c", "a"]]
    assert run(spark, baskets, sets, min_size=0) == brute(baskets, sets, 0)
    assert run(spark, baskets, sets) == brute(baskets, sets)
    assert run(spark, [], sets) == [0 if s is not None else None for s in sets]
    assert run(spark, baskets, []) == []
    assert run(spark, [[1, 2, 3], [2, 3]], [[3, 2], [1, 3]], "int") == [2, 1]


def test_hot_basket_and_clashing_names(spark):
    """A third of the baskets are equal; the sets' table has a column count."""
    b = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.array(F.lit("p"), F.lit("q"), F.lit("r"))).otherwise(
        F.array(F.lit("p"), (F.col("id") % 7).cast("string"))).alias("items"))
    w = spark.createDataFrame([(["p", "q"], 5), (["q", "r", "p"], 6), (["3", "p"], 7)], "items array<string>, count int")
    got = {tuple(r["items"]): r["count"] for r in I.count_given_sets(b, "items", w).collect()}
    third = sum(1 for i in range(3000) if i % 3 and i % 7 == 3)
    assert got == {("p", "q"): 1000, ("q", "r", "p"): 1000, ("3", "p"): third}


def test_fp_growth_with_a_third_of_equal_baskets(spark):
    b = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, F.array(F.lit("p"), F.lit("q"), F.lit("r"))).otherwise(
        F.array(F.lit("p"), (F.col("id") % 5).cast("string"))).alias("items"))
    one = {(tuple(r["items"]), r["count"]) for r in I.frequent_itemsets(b, "items", 10, 10).collect()}
    two = {(tuple(r["items"]), r["count"]) for r in I.frequent_itemsets_fpgrowth(b, "items", 10, 10, 3).collect()}
    assert one == two and any(n == 200 for _, n in one)
