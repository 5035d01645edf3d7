"""Hot keys: one token / item / key holds a third of all rows, and one basket
is very large. Results must stay whole and exact."""

from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from cascara.operators import itemsets as I
from cascara.operators import segments as G
from cascara.operators import tables as T
from cascara.operators import text as X

N = 30_000


def test_hot_token_counts_exact(spark):
    # every third line is the hot token; the rest spread over 1000 tokens
    lines = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot hot"))
        .otherwise(F.concat(F.lit("t"), (F.col("id") % 1000).cast("string"))).alias("value"))
    got = {r["token"]: r["count"] for r in X.token_counts(lines, sort=False).collect()}
    assert got["hot"] == 2 * (N // 3)
    assert sum(got.values()) == 2 * (N // 3) + (N - N // 3)


def test_hot_item_and_huge_basket_mining_exact(spark):
    # baskets: a third contain the hot item "h"; one basket holds 5000 items
    rows = []
    for i in range(3000):
        b = {f"i{i % 7}", f"i{(i * 3) % 11}"}
        if i % 3 == 0:
            b.add("h")
        rows.append((i, sorted(b)))
    rows.append((3000, sorted({f"x{k}" for k in range(5000)} | {"h", "i1", "i2"})))
    df = spark.createDataFrame(rows, "id int, items array<string>")
    got = {r["label"]: r["count"]
           for r in I.frequent_itemsets(df, "items", 150, 40, max_len=3).collect()}

    cnt = Counter(x for _, b in rows for x in b)
    freq = sorted((x for x in cnt if cnt[x] > 150), key=lambda x: (-cnt[x], x))
    rank = {x: k for k, x in enumerate(freq)}
    want = Counter()
    for _, b in rows:
        f = sorted((x for x in b if x in rank), key=rank.get)
        for L in (2, 3):
            for c in combinations(f, L):
                want["-".join(c)] += 1
    want = {k: v for k, v in want.items() if v > 40}
    assert got == want and any(k.startswith("h-") or "-h" in k for k in got)


def test_hot_key_join_and_aggregate_exact(spark):
    fact = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("item_id"),
        (F.col("id") % 5).cast("double").alias("rating"))
    items = spark.range(500).select(F.col("id").alias("item_id"),
                                    F.concat(F.lit("n"), F.col("id").cast("string")).alias("title"),
                                    F.array(F.lit("all")).alias("tags"))
    out = T.top_rated(fact, items, "item_id", "rating", "title", F.col("tags"), "all", 0, sort=False)
    hot = out.where(F.col("item_id") == 0).first()
    n_hot = N // 3 + sum(1 for i in range(N) if i % 3 != 0 and i % 500 == 0)
    assert hot["rating_count"] == n_hot
    assert out.agg(F.sum("rating_count")).first()[0] == N


def test_hot_size_segmentation(spark):
    sizes = spark.range(N).select(
        F.col("id").alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit(2)).otherwise(F.col("id") % 50 + 1).alias("n"))
    by = {r["size"]: r["count"] for r in G.rows_by_set_size(sizes, "n").collect()}
    assert by[2] == N // 3 + sum(1 for i in range(N) if i % 3 != 0 and i % 50 == 1)
    assert G.non_rare_max(sizes, "n").first()["max_non_rare"] == 50
