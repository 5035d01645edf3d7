"""String helpers: whitespace strip + single-space split, literal split, prefix."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Python ``str.strip()`` removes, i.e. every
# code point for which ``str.isspace()`` is true: U+0009-U+000D,
# U+001C-U+001F, U+0020, U+0085, U+00A0, U+1680, U+2000-U+200A, U+2028,
# U+2029, U+202F, U+205F, U+3000.
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_split(line: str | Column) -> Column:
    """Strip surrounding whitespace, then split on every single space.

    Empty tokens survive (two spaces give an empty token; a blank line gives
    ``['']``) and tabs inside a line do not split.
    """
    # btrim with a character set is a plain scan from both ends (no regex).
    return F.split(F.btrim(_col(line), F.lit(WHITESPACE_CHARS)), " ", -1)


def split_on(s: str | Column, delimiter: str) -> Column:
    """Split on a literal delimiter (regex metacharacters are escaped)."""
    return F.split(_col(s), re.escape(delimiter), -1)
