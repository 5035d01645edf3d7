"""Global 1-based row numbers without funnelling the table
through one task.

``row_number().over(Window.orderBy(...))`` with no partition moves every row
into a single partition. Instead: range-partition on the order and write the
rows with their range's number, then number rows inside each range and add the
row count of all earlier ranges. Both come from the one written table, so they
cannot disagree about the ranges' bounds. The offsets table has one row per
range, so broadcasting it is bounded by the partition count, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cascara.session import materialize


def global_row_number(
    df: DataFrame, order: list[Column], name: str = "rank", partitions: int | None = None
) -> DataFrame:
    """``df`` with a bigint 1..N in ``order`` (an action: the ranged rows are
    written once below the shared folder)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.repartitionByRange(n, *order)
                         .withColumn("_pid", F.spark_partition_id()), "ranged")
    local = ranged.withColumn(
        "_local", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)))
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_pid",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_off"),
    )
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + F.col("_local").cast("bigint"))
            .drop("_pid", "_local", "_off"))
