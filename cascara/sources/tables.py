"""Parquet tables of a data directory (one ``<name>.parquet`` per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; column pruning and filters reach the scan through
    Catalyst, so callers should select/filter rather than pre-project here."""
    return spark.read.parquet(os.path.join(data_dir, f"{name}.parquet"))
