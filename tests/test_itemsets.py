from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from cascara.operators import itemsets as I
from cascara.operators.ranking import global_row_number

BASKETS = [
    "80-23-443", "80-23", "80-23-22", "80-443", "23-443-22", "80-23-443-22", "80", "",
    "80-80-23", "22-23", "443-80-23-8080", "8080", "23-80-22-443",
]


def _brute(baskets, t_item, t_set, max_len):
    sets = [sorted(set(b.split("-"))) for b in baskets]
    cnt = Counter(x for s in sets for x in s)
    freq = sorted((x for x in cnt if cnt[x] > t_item), key=lambda x: (-cnt[x], x))
    rank = {x: i for i, x in enumerate(freq)}
    out = {}
    for L in range(2, max_len + 1):
        c = Counter()
        for s in sets:
            f = sorted((x for x in s if x in rank), key=rank.get)
            for combo in combinations(f, L):
                c[combo] += 1
        out.update({"-".join(k): v for k, v in c.items() if v > t_set})
    return out, freq, cnt


def _df(spark, baskets):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(baskets)], "id int, s string")
    return df.select("id", F.split("s", "-").alias("items"))


def test_levelwise_matches_brute_force(spark):
    df = _df(spark, BASKETS)
    want, _, _ = _brute(BASKETS, 2, 1, 4)
    got = I.frequent_itemsets(df, "items", 2, 1, max_len=4)
    got = {r["label"]: r["count"] for r in got.collect()}
    assert got == want and len(want) > 5


def test_strict_thresholds_and_ties(spark):
    df = _df(spark, BASKETS)
    _, freq, cnt = _brute(BASKETS, 0, 0, 2)
    t = cnt["443"]  # an item whose count equals the threshold is not frequent
    got = {r["item"] for r in I.frequent_items(I.item_counts(df, "items", sort=False), t).collect()}
    assert "443" not in got and all(cnt[x] > t for x in got)


def test_emitted_in_lexicographic_rank_order_of_frequent_items(spark):
    df = _df(spark, BASKETS)
    got = I.frequent_itemsets(df, "items", 1, 0, max_len=3).collect()
    ranked = {r["item"]: r["rank"] for r in I.rank_items(
        I.frequent_items(I.item_counts(df, "items", sort=False), 1)).collect()}
    keys = [(r["level"], [ranked[x] for x in r["items"]]) for r in got]
    assert keys == sorted(keys)
    assert all(x in ranked for r in got for x in r["items"])


def test_properties_of_levels(spark):
    df = _df(spark, BASKETS)
    got = I.frequent_itemsets(df, "items", 1, 0, max_len=3).collect()
    pairs = {r["label"]: r["count"] for r in got if r["level"] == 2}
    ranked = {r["item"]: r["rank"] for r in I.rank_items(
        I.frequent_items(I.item_counts(df, "items", sort=False), 1)).collect()}
    for r in got:
        ranks = [ranked[x] for x in r["items"]]
        assert ranks == sorted(ranks)  # labels are in rank order
        if r["level"] == 3:
            a, b, c = r["items"]
            for p in (f"{a}-{b}", f"{a}-{c}", f"{b}-{c}"):
                assert r["count"] <= pairs[p]


def test_duplicates_count_once(spark):
    df = _df(spark, ["a-a-b", "a-b"])
    counts = {r["item"]: r["count"] for r in I.item_counts(df, "items").collect()}
    assert counts == {"a": 2, "b": 2}


def test_fpgrowth_cross_check(spark):
    df = _df(spark, BASKETS)
    lw = {r["label"]: r["count"] for r in I.frequent_itemsets(df, "items", 2, 1, max_len=10).collect()}
    fp = I.frequent_itemsets_fpgrowth(df, "items", 2, 1)
    assert lw == {r["label"]: r["count"] for r in fp.collect()}


def test_contains_all_count(spark):
    df = _df(spark, BASKETS)
    n = I.count_containing_all(df, "items", ["80", "23"]).first()["count"]
    chained = df.where(F.size("items") >= 2).where(F.array_contains("items", "80")).where(
        F.array_contains("items", "23")).count()
    assert n == chained == sum(1 for b in BASKETS if {"80", "23"} <= set(b.split("-")))


def test_global_row_number_matches_sort(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 1000).alias("v"), "id")
    got = global_row_number(df, [F.desc("v"), F.asc("id")], "rn", partitions=7)
    rows = sorted(got.collect(), key=lambda r: r["rn"])
    assert [r["rn"] for r in rows] == list(range(1, 5001))
    keys = [(-r["v"], r["id"]) for r in rows]
    assert keys == sorted(keys)


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_global_row_number_with_payload_and_without_exchange_reuse(spark, reuse):
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        n = 100_000
        df = spark.range(0, n).select((F.col("id") * 7919 % 1009).alias("v"), "id",
                                      F.md5(F.col("id").cast("string")).alias("payload"))
        got = global_row_number(df, [F.desc("v"), F.asc("id")], "rn", partitions=8)
        assert dict(got.dtypes)["rn"] == "bigint"
        row = got.agg(F.count_distinct("rn"), F.min("rn"), F.max("rn")).first()
        assert tuple(row) == (n, 1, n)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def _sets(df):
    return sorted((r["level"], tuple(r["items"]), r["count"]) for r in df.collect())


def test_null_items_are_no_items(spark):
    rows = [(["a", "b", None],)] * 2 + [(["a", "b"],), (["a", None],), (None,), ([None, None],), ([],)]
    df = spark.createDataFrame(rows, "items array<string>")
    assert _sets(I.frequent_itemsets(df, "items", 1, 0)) == [(2, ("a", "b"), 3)]
    assert {r["item"]: r["count"] for r in I.item_counts(df, "items").collect()} == {"a": 4, "b": 3}
    assert _sets(I.frequent_itemsets_fpgrowth(df, "items", 1, 0)) == [(2, ("a", "b"), 3)]


def test_integer_items_and_no_frequent_item(spark):
    df = spark.createDataFrame([([3, 1, 2],), ([1, 2],), ([2, 9],)], "items array<int>")
    assert _sets(I.frequent_itemsets(df, "items", 1, 0)) == [(2, (2, 1), 2)]
    none = I.frequent_itemsets(df, "items", 99, 0)
    assert dict(none.dtypes)["items"] == "array<int>" and none.count() == 0
    assert I.frequent_itemsets(df.limit(0), "items", 0, 0).count() == 0


def test_labels_may_meet_but_items_do_not(spark):
    df = spark.createDataFrame([(["a", "b-c"],), (["a-b", "c"],)], "items array<string>")
    got = I.frequent_itemsets(df, "items", 0, 0).collect()
    assert sorted(tuple(r["items"]) for r in got) == [("a", "b-c"), ("a-b", "c")]


def test_one_basket_of_two_thousand_frequent_items(spark):
    big = [f"x{k:04d}" for k in range(2000)]
    rows = [(big,)] + [([x],) for x in big] + [(big[:3],)]
    df = spark.createDataFrame(rows, "items array<string>")
    assert _sets(I.frequent_itemsets(df, "items", 1, 1)) == sorted(
        [(2, p, 2) for p in combinations(big[:3], 2)] + [(3, tuple(big[:3]), 2)])


def test_start_from_a_saved_level(spark):
    df = _df(spark, BASKETS)
    whole = I.frequent_itemsets(df, "items", 2, 1, max_len=4)
    for level in (2, 3):
        saved = I.frequent_itemsets(df, "items", 2, 1, max_len=level, min_len=level)
        on = I.frequent_itemsets(df, "items", 2, 1, max_len=4, start=saved)
        assert _sets(on) == [r for r in _sets(whole) if r[0] >= level]
