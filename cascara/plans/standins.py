"""Inputs of the reference's shapes, derived by Spark from the supplied tables
(see FIXTURES.md). Everything stays lazy; work grows with the tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascara.functions import split_on
from cascara.sources import load_table


def doc_lines(spark: SparkSession, d: str) -> DataFrame:
    """Text lines: every document split on newline, one row per line."""
    docs = load_table(spark, d, "documents").select("text")
    return docs.select(F.explode(F.split("text", "\n", -1)).alias("value"))


def tagged_events(spark: SparkSession, d: str) -> DataFrame:
    """Tagged text with a day: ``type #type #u<user>`` per event."""
    ev = load_table(spark, d, "events")
    return ev.select(
        "ts",
        F.to_date("ts").alias("day"),
        F.concat_ws(" ", "event_type", F.concat(F.lit("#"), "event_type"),
                    F.concat(F.lit("#u"), F.col("user_id").cast("string"))).alias("value"),
    )


def first_days(spark: SparkSession, d: str):
    """The first two calendar days of ``events`` as dates (one scalar reaches
    the driver), so the day filter can be pushed into the scan."""
    first = load_table(spark, d, "events").agg(F.to_date(F.min("ts"))).first()[0]
    if first is None:  # no events: no day matches
        return None, None
    return first, first + dt.timedelta(days=1)


def ratings(spark: SparkSession, d: str) -> DataFrame:
    """Ratings: (item = l_partkey, rating = l_quantity)."""
    return load_table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("item_id"), F.col("l_quantity").alias("rating"))


def items_with_tags(spark: SparkSession, d: str) -> DataFrame:
    """Items: (item_id, title, tags = words of p_name)."""
    return load_table(spark, d, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"),
        split_on("p_name", " ").alias("tags"))


def brand_sets(spark: SparkSession, d: str) -> DataFrame:
    """Baskets for mining: per order the distinct brands, in order.

    lineitem x part is a large-large equi-join at scale (sort-merge, AQE may
    broadcast part when it is small). ``collect_set`` combines map-side, and
    each partial set is bounded by the brand vocabulary, so even a hot order
    ships at most (map tasks x brands) values to its reducer. Contrast
    :func:`part_profiles`, whose sets can be as large as the supplier table.
    """
    li = load_table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    part = load_table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return (li.join(part, "l_partkey")
            .groupBy(F.col("l_orderkey").alias("basket_id"))
            .agg(F.array_sort(F.collect_set("p_brand")).alias("items")))


def part_profiles(spark: SparkSession, d: str) -> DataFrame:
    """Set-valued profile rows: per part, the distinct suppliers as a '-'
    string, its size (``numports``) and a flag (``p_type = 'PROMO'``)."""
    li = load_table(spark, d, "lineitem").select("l_partkey", "l_suppkey")
    # Distinct (part, supplier) first: that aggregate is keyed by both columns,
    # so a part holding a third of all lines still spreads over reducers and
    # combines map-side; the per-part collect then receives each supplier once.
    pairs = li.distinct()
    sets = pairs.groupBy(F.col("l_partkey").alias("id")).agg(
        F.array_sort(F.collect_list(F.col("l_suppkey").cast("string"))).alias("_s"))
    part = load_table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), (F.col("p_type") == "PROMO").alias("flag"))
    return sets.join(part, "id").select(
        "id", F.size("_s").alias("numports"), F.concat_ws("-", "_s").alias("items_str"), "flag")


def part_sizes(spark: SparkSession, d: str) -> DataFrame:
    """:func:`part_profiles` without the set itself, for queries that need its
    size only: a distinct count, no array."""
    li = load_table(spark, d, "lineitem").select("l_partkey", "l_suppkey")
    part = load_table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), (F.col("p_type") == "PROMO").alias("flag"))
    sizes = li.groupBy(F.col("l_partkey").alias("id")).agg(
        F.count_distinct("l_suppkey").cast("int").alias("numports"))
    return sizes.join(part, "id").select("id", "numports", "flag")


def tree_rows(spark: SparkSession, d: str, unlabelled: bool = False) -> DataFrame:
    """Decision-tree rows: documents with labels (or all); numeric features."""
    docs = load_table(spark, d, "documents").select("doc_id", "text", "n_chars")
    labels = load_table(spark, d, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left" if unlabelled else "inner").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1).cast("double").alias("words"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("double").alias("lines"),
        F.col("quality").cast("double").alias("label"),
    )


def user_item_ratings(spark: SparkSession, d: str) -> DataFrame:
    """ALS triples: (user = o_custkey, item = l_partkey, rating = mean
    quantity of that pair)."""
    li = load_table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = load_table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return (li.join(od, "l_orderkey")
            .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
            .agg(F.avg("l_quantity").cast("float").alias("rating")))


def letter_shares(spark: SparkSession, d: str) -> DataFrame:
    """ALS triples with a structure: (user = doc_id, item = letter 0..25, rating =
    its share of the text's characters, in per cent). Languages differ in them."""
    docs = load_table(spark, d, "documents").where("length(text) > 0").select(
        F.col("doc_id").alias("user"), F.lower("text").alias("t"))
    shares = F.array(*[100 * (F.length("t") - F.length(F.replace("t", F.lit(chr(97 + i)), F.lit("")))) / F.length("t")
                       for i in range(26)])
    return docs.select("user", F.posexplode(shares).alias("item", "rating")).withColumn(
        "rating", F.col("rating").cast("float"))
