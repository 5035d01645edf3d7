"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascara.llm.common import materialize


def _least(pairs: DataFrame) -> DataFrame:
    """(u, v, m): each edge with the least of u and all its neighbours. The
    minimum is combined before the shuffle, so a hub costs no more than others."""
    m = pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return pairs.join(m, "u")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node on an edge; root is the component's least node.

    Alternates the large-star and small-star steps until nothing changes: the
    number of rounds grows with the logarithm of a component's size, and each
    round is written to the shared folder, so lineage stays short and a lost
    executor costs one round at most.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    e, before = materialize(e, "edges"), None
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u <> v").distinct(), "large-star")
        # Every u of large is greater than its v: the lesser neighbours are whole.
        least = _least(large)
        small = (least.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(least.select("u", F.col("m").alias("v")))
                 .where("u <> v").distinct())
        e = materialize(small, "small-star")
        mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    # Stars: every node points to its root; roots point to nothing.
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
