"""Top-k items and one-hot features."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cascara.operators.itemsets import item_counts


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def top_k_items(rows: DataFrame, items: str | Column, k: int) -> DataFrame:
    """The k most common items, (item, count, rank); ties by item.
    ``orderBy().limit(k)`` plans as TakeOrderedAndProject: each task keeps
    only its own k best rows, so nothing unbounded reaches one task."""
    top = item_counts(rows, items, sort=True).limit(k)
    # The window sees only the k rows left after the limit.
    rank = F.row_number().over(Window.orderBy(F.desc("count"), "item"))
    return top.withColumn("rank", rank.cast("int"))


def top_k_names(rows: DataFrame, items: str | Column, k: int) -> list[str]:
    """The names of the top-k items in rank order. Action; at most k values
    reach the driver (they become column names)."""
    return [r["item"] for r in top_k_items(rows, items, k).orderBy("rank").collect()]


def one_hot_items(
    rows: DataFrame, items: str | Column, names: list[str], prefix: str = "item_",
    name_by: str = "item",
) -> DataFrame:
    """One boolean column per named item, all in ONE projection.
    Columns are named ``prefix + item`` or, with ``name_by='rank'``,
    ``prefix + <1-based rank>``."""
    # The named items of a row are found once; each column then looks among them
    # and not through the whole row again.
    hot = F.filter(_col(items), lambda x: x.isin([n for n in names if n is not None]))
    cols = [
        F.coalesce(F.array_contains("_hot", F.lit(n).cast("string")), F.lit(False) if n is not None else
                   F.lit(None)).alias(f"{prefix}{n if name_by == 'item' else i + 1}")
        for i, n in enumerate(names)
    ]
    return rows.withColumn("_hot", hot).select("*", *cols).drop("_hot")


def one_hot_check(onehot: DataFrame, rows: DataFrame, items: str | Column,
                  names: list[str], prefix: str = "item_", name_by: str = "item") -> DataFrame:
    """Per one-hot column, the number of true values next to the item's
    count among the same rows (they must be equal). One pass for all
    columns, unpivoted to (rank, item, true_count, item_count)."""
    cols = [f"{prefix}{n if name_by == 'item' else i + 1}" for i, n in enumerate(names)]
    wide = onehot.agg(*[F.count_if(F.col(c)).alias(f"t{i}") for i, c in enumerate(cols)])
    trues = wide.select(F.inline(F.array(*[
        F.struct(F.lit(i + 1).alias("rank"), F.lit(n).alias("item"),
                 F.col(f"t{i}").alias("true_count")) for i, n in enumerate(names)])))
    # Only the k named items are counted: the filter sits below the aggregate.
    occ = rows.select(F.explode(F.array_distinct(_col(items))).alias("item"))
    counts = (occ.where(F.col("item").isin([n for n in names if n is not None]))
              .groupBy("item").agg(F.count(F.lit(1)).alias("item_count")))
    return trues.join(counts, "item", "left").select(
        "rank", "item", "true_count", F.coalesce("item_count", F.lit(0)).alias("item_count"))


def one_hot_vector(rows: DataFrame, items: str | Column, names: list[str],
                   out: str = "features") -> DataFrame:
    """E2 for large k: the same indicators as :func:`one_hot_items`, built
    straight into a sparse vector (index i = i-th name) by a CountVectorizer
    with a fixed vocabulary and binary counts, so no k wide columns exist."""
    from pyspark.ml.feature import CountVectorizerModel

    src = "_items_for_vector"
    model = CountVectorizerModel.from_vocabulary(names, inputCol=src, outputCol=out, binary=True)
    with_items = rows.withColumn(src, F.coalesce(F.array_distinct(_col(items)),
                                                 F.array().cast("array<string>")))
    return model.transform(with_items).drop(src)


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Feature vector from numeric/boolean columns."""
    return VectorAssembler(inputCols=cols, outputCol=out).transform(df)
