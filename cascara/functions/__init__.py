"""Column-level building blocks (X1-X8). All are built-in Spark expressions:
no Python UDF runs anywhere in the library."""

from cascara.functions.strings import strip_split, split_on, WHITESPACE_CHARS
from cascara.functions.sets import contains_all, item_label, null_to_zero, ratio

__all__ = [
    "strip_split", "split_on", "WHITESPACE_CHARS", "contains_all",
    "item_label", "null_to_zero", "ratio",
]
