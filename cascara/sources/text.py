"""Text lines, one row per line in column ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_text_lines(spark: SparkSession, path: str | list[str],
                    source_col: str | None = None) -> DataFrame:
    """``spark.read.text``: splittable line reader, one ``value`` per line.

    Several paths (e.g. one file per day) are read as one DataFrame; with
    ``source_col`` each line also carries the path of its file (from the
    file-source metadata column), so a day can be derived from the name."""
    df = spark.read.text(path if isinstance(path, str) else list(path))
    if source_col:
        df = df.select("value", F.col("_metadata.file_path").alias(source_col))
    return df
