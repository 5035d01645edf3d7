"""Segmentation of set-valued rows by set size (SG1, SG2, A5, A10).

Segments: ``single`` (size 1), ``extreme`` (size above the cut-off),
``multi`` (size 2 .. cut-off), ``other`` (size 0 or NULL). The cut-off is the
largest size shared by at least two multi-item rows; it is a scalar subquery,
so no value travels through the driver and no cross join is planned. When no
size is shared, the cut-off falls back to 1 and every multi-item row is
extreme.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rows_by_set_size(rows: DataFrame, size: str | Column, sort: bool = True) -> DataFrame:
    """A10: (size, count) over multi-item rows, most common size first."""
    s = _col(size)
    out = (rows.where(s > 1).groupBy(s.alias("size"))
           .agg(F.count(F.lit(1)).alias("count")))
    return out.orderBy(F.desc("count"), "size") if sort else out


def non_rare_max(rows: DataFrame, size: str | Column) -> DataFrame:
    """A5 + F9: one row, the largest size shared by at least two multi-item
    rows (NULL when none is shared)."""
    by = rows_by_set_size(rows, size, sort=False)
    return by.where(F.col("count") > 1).agg(F.max("size").alias("max_non_rare"))


def cutoff(rows: DataFrame, size: str | Column) -> Column:
    """The cut-off as a scalar-subquery Column."""
    return F.coalesce(non_rare_max(rows, size).scalar(), F.lit(1))


def segment_rows(rows: DataFrame, size: str | Column, name: str = "segment") -> DataFrame:
    """SG1: every row with its segment label."""
    s = _col(size)
    c = cutoff(rows, size)
    label = (F.when(s == 1, "single").when(s > c, "extreme")
             .when(s > 1, "multi").otherwise("other"))
    return rows.withColumn(name, label)


def extreme_rows(rows: DataFrame, size: str | Column) -> DataFrame:
    """SG2: rows above the cut-off."""
    return rows.where(_col(size) > cutoff(rows, size))


def non_extreme_multi(rows: DataFrame, size: str | Column) -> DataFrame:
    """Rows with 1 < size <= cut-off (the population that is clustered)."""
    s = _col(size)
    return rows.where((s > 1) & (s <= cutoff(rows, size)))
