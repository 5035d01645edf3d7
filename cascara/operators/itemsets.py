"""Frequent item-set mining, level-wise.

Input: one row per basket with an array of items. Each basket counts once per
item (duplicates are removed first). Thresholds are strict: an item is
frequent when its basket count is ``> item_threshold``; a set of two or more
items when its count is ``> set_threshold``. Sets are reported in *rank
order*: items ordered by descending count, ties by item.

NULL items are no items: they are dropped before anything is counted.

One plan at every size, with no driver loop over candidates and no switch on
the number of frequent items:

1. Baskets are numbered by writing them once (or by a key column), so a retried
   task cannot number them anew. Item counts: ``explode`` + ``groupBy`` with
   partial aggregation, so a hot item is combined map-side; written once.
2. Frequent items are ranked; from here on a set is an array of integer ranks.
   Each basket is reduced to its *signature*, its ranks in order; identical
   signatures are pre-aggregated with a multiplicity before any candidate is
   made, so correlated data collapses to few rows.
3. Signatures are cut into *tails*: one row per position with the ranks after
   it, dealt by (signature, position), so one long signature spreads over many
   tasks.
4. Level L joins each occurrence of a frequent (L-1)-set with the tail at its
   last position, explodes the tail and sums multiplicities per set: candidates
   carry (signature, position, ranks), never a tail. Occurrences of the
   survivors are written below the shared folder, which cuts lineage and
   survives executor loss. Join strategies are left to AQE.

A level can start from a saved one (``start``): its sets are taken as they are
and only longer sets are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascara.functions import contains_all
from cascara.operators.ranking import global_row_number
from cascara.session import materialize


def _items(c: str | Column) -> Column:
    """Distinct items without NULLs."""
    return F.array_distinct(F.array_compact(_col(c)))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _thr(t) -> Column:
    return t if isinstance(t, Column) else F.lit(t)


# --- single items ------------------------------------------------------------

def item_counts(baskets: DataFrame, items: str | Column, sort: bool = True) -> DataFrame:
    """Number of baskets per item."""
    occ = baskets.select(F.explode(_items(items)).alias("item"))
    out = occ.groupBy("item").agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy(F.desc("count"), "item") if sort else out


def frequent_items(counts: DataFrame, threshold) -> DataFrame:
    """Items with count strictly above ``threshold``."""
    return counts.where(F.col("count") > _thr(threshold))


def rank_items(frequent: DataFrame) -> DataFrame:
    """(item, count, rank), rank 1 = most frequent, ties by item."""
    return global_row_number(frequent, [F.desc("count"), F.asc("item")], "rank")


def count_containing_all(baskets: DataFrame, items: str | Column, wanted: list[str],
                         min_size: int = 2) -> DataFrame:
    """Number of baskets of at least ``min_size`` items holding every
    item of ``wanted`` (one pass, no per-item job)."""
    arr = _items(items)
    return baskets.agg(
        F.count_if((F.size(arr) >= min_size) & contains_all(arr, wanted)).alias("count"))


def baskets_of_size(baskets: DataFrame, items: str | Column, min_size: int) -> DataFrame:
    """baskets with at least ``min_size`` distinct items."""
    return baskets.where(F.size(_items(items)) >= min_size)


def count_given_sets(baskets: DataFrame, items: str | Column, wanted: DataFrame,
                     wanted_items: str = "items", min_size: int = 1) -> DataFrame:
    """I3 for many sets at once: ``wanted`` plus count, the number of baskets of at
    least ``min_size`` items that hold every item of the set.

    The sets' items are ranked rarest first, so the sets form a prefix tree whose
    first branches few baskets take. Baskets become arrays of those ranks, equal
    ones are summed up, and all walk the tree together: each level extends the
    walks by one item and keeps those that are a prefix of some set, so the work
    follows the matches, not the number of sets. One scan of the baskets.

    An item counts once a basket and once a set; NULL items are none. An empty set
    is held by every basket, a NULL set has a NULL count. Repeated sets are all
    answered. A set with an item that no basket holds has 0.
    """
    spark, arr, path = baskets.sparkSession, _items(items), "_path"
    rows = baskets.select(arr.alias("_b")).where(F.coalesce(F.size("_b"), F.lit(0)) >= min_size)
    sets = wanted.withColumn("_set", F.array_sort(_items(wanted_items)))
    known = sets.select(F.explode("_set").alias("item")).distinct()
    held = rows.select(F.monotonically_increasing_id().alias("_bid"), "_b")
    # Baskets without any wanted item only count for empty sets.
    held = materialize(held, "baskets")
    occ = held.select("_bid", F.explode("_b").alias("item")).join(known, "item")
    counts = materialize(occ.groupBy("item").agg(F.count(F.lit(1)).alias("count")), "item-counts")
    ranks = materialize(global_row_number(counts, [F.asc("count"), F.asc("item")], "r")
                        .select("item", F.col("r").cast("int").alias("r")), "wanted-ranks")
    sigs = (occ.join(ranks, "item").groupBy("_bid").agg(F.array_sort(F.collect_list("r")).alias("tail"))
            .groupBy("tail").agg(F.count(F.lit(1)).alias("n")).withColumn("sid", F.monotonically_increasing_id()))
    paths = (sets.where(F.size("_set") > 0).select("_set", F.explode("_set").alias("item")).distinct()
             .join(ranks, "item").groupBy("_set").agg(F.array_sort(F.collect_list("r")).alias(path))
             .where(F.size(path) == F.size("_set")))
    paths = materialize(paths, "paths")
    walks = materialize(sigs, "signatures").select("sid", "n", F.array().cast("array<int>").alias("at"), "tail")
    total = held.agg(F.count(F.lit(1))).first()[0]
    found = None
    for level in range(1, (paths.agg(F.max(F.size(path))).first()[0] or 0) + 1):
        step = walks.select("sid", "n", "at", "tail", F.posexplode("tail").alias("q", "r")).select(
            "sid", "n", F.concat("at", F.array("r")).alias("at"),
            F.slice("tail", F.col("q") + 2, F.size("tail")).alias("tail"))
        branch = paths.where(F.size(path) >= level).groupBy(F.slice(path, 1, level).alias("at")).agg(
            F.max(F.size(path) == level).alias("ends"))
        walks = materialize(step.join(branch, "at"), f"walks{level}")
        here = walks.where("ends").groupBy("at").agg(F.sum("n").alias("count"))
        found = here if found is None else found.unionAll(here)
        walks = walks.where(F.size("tail") > 0).drop("ends")
    answers = paths.select("_set", F.lit(None).cast("bigint").alias("count")).where("false") if found is None else (
        paths.join(found, paths[path] == found["at"]).select("_set", "count"))
    held_by = F.when(F.col("_set").isNull(), None).when(F.size("_set") == 0, F.lit(total)).otherwise(
        F.coalesce("_count", F.lit(0)))
    return (sets.drop("count").join(answers.withColumnRenamed("count", "_count"), "_set", "left")
            .select(*[c for c in wanted.columns if c != "count"], held_by.cast("bigint").alias("count")))


# --- level-wise mining ---------------------------------------------------------

def _value(spark, t) -> float:
    """A threshold as a number; a Column (e.g. a share of a scalar subquery)
    is evaluated once here instead of in every level's job."""
    if isinstance(t, Column):
        return float(spark.range(1).select(t.cast("double")).first()[0])
    return float(t)


def _prepared(baskets: DataFrame, items: str | Column, key: str | None, t_item: float,
              grouped: bool = True):
    """(ranked, signatures): ranked is (item, count, rank), signatures is
    (sid, n, sig array<int>) with at least two ranks, or with ``grouped`` false
    one row (sig) per basket; both are written."""
    name = F.col(key) if key else F.monotonically_increasing_id()
    numbered = baskets.select(name.alias("_bid"), _items(items).alias("_items"))
    occ = (numbered if key else materialize(numbered, "numbered")).select(
        "_bid", F.explode("_items").alias("item"))
    counts = materialize(occ.groupBy("item").agg(F.count(F.lit(1)).alias("count")), "item-counts")
    ranked = materialize(rank_items(frequent_items(counts, t_item)), "ranked-items")
    sig = (occ.join(ranked.select("item", F.col("rank").cast("int").alias("r")), "item")
           .groupBy("_bid").agg(F.array_sort(F.collect_list("r")).alias("sig")))
    if not grouped:
        return ranked, materialize(sig.where(F.size("sig") >= 2).select("sig"), "basket-signatures")
    sigs = (sig.where(F.size("sig") >= 2).groupBy("sig").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("sid", F.monotonically_increasing_id()))
    return ranked, materialize(sigs, "signatures")


def _extend(occ: DataFrame) -> DataFrame:
    """Occurrences (sid, p, set, n, tail) by every rank of their tail."""
    longer = occ.select("sid", "n", "p", "set", F.posexplode("tail").alias("q", "r"))
    return longer.select("sid", (F.col("p") + F.col("q") + 1).alias("p"), "n",
                         F.concat("set", F.array("r")).alias("set"))


def frequent_itemsets(
    baskets: DataFrame,
    items: str | Column,
    item_threshold,
    set_threshold,
    max_len: int = 3,
    min_len: int = 2,
    key: str | None = None,
    start: DataFrame | None = None,
) -> DataFrame:
    """All sets of ``min_len..max_len`` frequent items whose basket
    count is ``> set_threshold``.

    Returns (level int, items array in rank order, label string 'a-b-c', count
    bigint), ordered by level and ranks. Labels are for reading: with items that
    hold a '-' two sets can share one, ``items`` tells them apart. ``key`` names
    a column that is unique per basket. ``start`` is a saved result of one level
    (columns items and count) over the same baskets and thresholds: its sets
    are returned as they are and the search goes on above it.
    """
    spark = baskets.sparkSession
    t_item, t_set = _value(spark, item_threshold), _value(spark, set_threshold)
    ranked, sigs = _prepared(baskets, items, key, t_item)
    tails = (sigs.select("sid", "n", F.posexplode("sig").alias("p", "r"), "sig")
             .select("sid", "p", "n", "r", F.slice("sig", F.col("p") + 2, F.size("sig")).alias("tail"))
             .repartition("sid", "p"))
    if max_len > 2:  # read again by every level after the second
        tails = materialize(tails, "tails")
    tails = tails.where(F.size("tail") > 0)
    occ = tails.select("sid", "p", "n", F.array("r").alias("set"), "tail")
    tails = tails.select("sid", "p", "tail")
    begun = None if start is None else materialize(_ranks_of(start, ranked), "start")
    begun_at = 0 if start is None else (begun.agg(F.max(F.size("set"))).first()[0] or max_len)
    levels = []
    for level in range(2, max_len + 1):
        ext = _extend(occ)
        if level < begun_at:  # only what a saved set begins with
            found = begun.select(F.slice("set", 1, level).alias("set")).distinct()
        elif level == begun_at:
            found = begun
        else:
            found = materialize(ext.groupBy("set").agg(F.sum("n").alias("count"))
                                .where(F.col("count") > t_set), f"level{level}")
        if level >= max(min_len, begun_at):
            levels.append(found.withColumn("level", F.lit(level)))
        if level == max_len or (level > begun_at and found.isEmpty()):
            break
        occ = materialize(ext.join(found.select("set"), "set", "left_semi"), f"occ{level}")
        occ = occ.join(tails, ["sid", "p"])
    return _label(spark, levels, ranked)


def _ranks_of(start: DataFrame, ranked: DataFrame) -> DataFrame:
    """(set, count) of named sets whose items are all ranked."""
    named = start.select("count", F.col("items").alias("_items"), F.explode("items").alias("item"))
    return (named.join(ranked, "item").groupBy("_items", named["count"])
            .agg(F.array_sort(F.collect_list(F.col("rank").cast("int"))).alias("set"))
            .where(F.size("set") == F.size("_items")).select("set", "count"))


def _label(spark, levels: list[DataFrame], ranked: DataFrame) -> DataFrame:
    """(level, set, count) -> (level, items, label, count) with items in rank
    order, rows ordered by level, then lexicographically by ranks (the order
    in which nested loops over ranks i < j < k would emit the sets)."""
    kind = ranked.schema["item"].dataType.simpleString()
    if not levels:
        return spark.createDataFrame(
            [], f"level int, items array<{kind}>, label string, count bigint")
    sets = levels[0]
    for extra in levels[1:]:
        sets = sets.unionByName(extra)
    occ = sets.select("level", "count", "set", F.explode("set").alias("rank"))
    named = (occ.join(ranked.select("item", F.col("rank").cast("int").alias("rank")), "rank")
             .groupBy("level", "set", "count")
             .agg(F.array_sort(F.collect_list(F.struct("rank", "item"))).alias("_pairs"))
             .withColumn("items", F.transform("_pairs", lambda p: p["item"])))
    return named.orderBy("level", "set").select(
        F.col("level").cast("int").alias("level"), "items",
        F.concat_ws("-", F.transform("items", lambda x: x.cast("string"))).alias("label"),
        F.col("count").cast("bigint").alias("count"))


def frequent_itemsets_fpgrowth(baskets: DataFrame, items: str | Column, item_threshold,
                               set_threshold, max_len: int | None = None,
                               key: str | None = None) -> DataFrame:
    """Cross-check of :func:`frequent_itemsets` with MLlib's parallel
    FP-growth on the same signatures, a row per basket: however many baskets share
    one, they stay spread over tasks. With n trimmed baskets,
    ``minSupport = (m - 0.5) / n`` where ``m = floor(t) + 1`` makes the
    smallest accepted count m (strict ``>``). FP-growth itself has no length
    limit; sets longer than ``max_len`` are left out of the result."""
    from pyspark.ml.fpm import FPGrowth

    spark = baskets.sparkSession
    t_item, t_set = _value(spark, item_threshold), _value(spark, set_threshold)
    ranked, trimmed = _prepared(baskets, items, key, t_item, grouped=False)
    n = trimmed.count()
    min_count = int(t_set) + 1 if t_set >= 0 else 0
    model = FPGrowth(itemsCol="sig", minSupport=(min_count - 0.5) / max(n, 1),
                     minConfidence=1.0).fit(trimmed)
    wanted = F.size("items") >= 2
    if max_len is not None:
        wanted = wanted & (F.size("items") <= max_len)
    sets = model.freqItemsets.where(wanted).select(
        F.size("items").alias("level"), F.array_sort("items").alias("set"),
        F.col("freq").alias("count"))
    return _label(spark, [sets], ranked)
