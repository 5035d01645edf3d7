"""Array membership, labels and null-safe arithmetic."""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def contains_all(arr: str | Column, items: Iterable) -> Column:
    """True when the array holds every one of ``items``."""
    tests = [F.array_contains(_col(arr), F.lit(v)) for v in items]
    return reduce(lambda a, b: a & b, tests)


def item_label(*items: str | Column, sep: str = "-") -> Column:
    """Item-set label ``a-b-c``."""
    return F.concat_ws(sep, *[_col(i) for i in items])


def null_to_zero(c: str | Column) -> Column:
    """Missing side of an outer join counts as 0."""
    return F.coalesce(_col(c), F.lit(0))


def ratio(num: str | Column, den: str | Column) -> Column:
    """Division that yields NULL instead of failing on a zero denominator."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
