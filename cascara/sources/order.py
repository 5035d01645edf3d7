"""O1-O3 as written: is a sorted result in order in its files?

A sorted write gives each task a range and the task's file its place by name, so
the whole is in order if every file is and each file's first row does not precede
the last row of the file before it. Both are checked where the rows are: a file
block is read by one task in file order, so rows are compared with their
neighbours inside a block, and only first and last rows of blocks meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def written_rows(spark: SparkSession, path: str, kind: str, schema: str, **options) -> DataFrame:
    """The rows of a file source with _file, _block and _row, their place: file,
    offset of the block in it, and a number that rises inside the block."""
    rows = spark.read.format(kind).schema(schema).options(**options).load(path)
    return rows.select("*", F.col("_metadata.file_name").alias("_file"),
                       F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_row"))


def _precedes(a: str, b: str, descending: bool) -> Column:
    """Whether value ``a`` must come before ``b``: NULL first, or last if descending."""
    a, b = F.col(a), F.col(b)
    if descending:
        return F.coalesce(a > b, F.lit(False)) | (a.isNotNull() & b.isNull())
    return F.coalesce(a < b, F.lit(False)) | (a.isNull() & b.isNotNull())


def order_faults(rows: DataFrame, keys: list[tuple[str, bool]]) -> DataFrame:
    """One row (rows, files, inversions) for ``rows`` with the places of
    :func:`written_rows` and ``keys`` (column, descending?): how many rows must
    come before the row written just ahead of them, in their file or in the one
    before. 0 says that the result is sorted as written."""
    names = [c for c, _ in keys]

    def inverted(before: str) -> Column:
        out, equal = F.lit(False), F.lit(True)
        for c, descending in keys:
            out = out | (equal & _precedes(c, f"{before}.{c}", descending))
            equal = equal & F.col(c).eqNullSafe(F.col(f"{before}.{c}"))
        return out

    place, key = ["_file", "_block"], F.struct(*names)
    ahead = F.lag(key).over(Window.partitionBy(*place).orderBy("_row"))  # one block of a file
    inside = rows.select(*names, *place, "_row", ahead.alias("_ahead"))
    blocks = inside.groupBy(*place).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("_ahead").isNotNull() & inverted("_ahead")).alias("_bad"),
        F.min_by(key, "_row").alias("_first"), F.max_by(key, "_row").alias("_last"))
    # One row per block of a file.
    between = blocks.withColumn("_ahead", F.lag("_last").over(Window.orderBy(*place))).select(
        "_file", "_n", "_bad", "_ahead", "_first.*")
    return between.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count_distinct("_file").alias("files"),
        (F.coalesce(F.sum("_bad"), F.lit(0))
         + F.count_if(F.col("_ahead").isNotNull() & inverted("_ahead"))).alias("inversions"))
