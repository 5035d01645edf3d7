"""K1-K4: text and CSV sinks.

The default mode is ``errorifexists``: like the reference's text output, a
write to an existing path fails instead of silently replacing results.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _codes(sep: str) -> list[tuple[str, str]]:
    """(string, code) pairs: after the first, every backslash begins a code, so
    the others can be replaced back one by one."""
    return [("\\", "\\s"), (sep, "\\t"), ("\n", "\\n"), ("\r", "\\r")]


def write_text(df: DataFrame, path: str, sep: str = "\t", mode: str = "errorifexists",
               escape: bool = True) -> None:
    """One line per row, fields joined by ``sep``. Separators, line ends and
    backslashes inside a field are escaped and NULL is ``\\N``, so
    :func:`read_fields` gets every row back. With ``escape=False`` fields are
    written as they are (NULL as nothing): their line ends make more lines."""
    fields = []
    for c in df.columns:
        field = F.col(c).cast("string")
        for plain, code in _codes(sep) if escape else ():
            field = F.replace(field, F.lit(plain), F.lit(code))
        fields.append(F.coalesce(field, F.lit("\\N" if escape else "")))
    line = F.concat_ws(sep, *fields)
    df.select(line.alias("value")).write.mode(mode).text(path)


def read_fields(spark: SparkSession, path: str, schema: str, sep: str = "\t") -> DataFrame:
    """The rows of :func:`write_text`, cast to ``schema``."""
    lines = spark.read.option("lineSep", "\n").text(path)
    parts = F.split("value", re.escape(sep), -1)
    out = []
    for i, f in enumerate(T._parse_datatype_string(schema)):
        field = F.when(parts[i] != "\\N", parts[i])
        for plain, code in reversed(_codes(sep)):
            field = F.replace(field, F.lit(code), F.lit(plain))
        out.append(field.cast(f.dataType).alias(f.name))
    return lines.select(*out)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists") -> None:
    """CSV files, one per partition, optionally with a header line each."""
    df.write.mode(mode).option("header", header).csv(path)
