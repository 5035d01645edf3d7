"""From raw documents to a token mix, in five stages.

Every stage takes what its predecessor kept and returns the columns of
``documents`` (the last: one row per record written). ``run`` writes each
stage's rows to the shared folder and reads them again, so a stage is its own
unit of recovery. Stages pass extra columns over; nulls, repeated rows and
empty tables are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascara.llm.common import load_table, scratch_path
from cascara.llm.decontaminate import decontaminate
from cascara.llm.mixing import mix
from cascara.llm.quality_model import classify
from cascara.llm.simhash import one_of_each
from cascara.llm.token_records import index_records, write_records

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    scored = classify(docs.select(COLUMNS), load_table(spark, sf_dir, "labels"))
    return scored.where(~F.col("rejected")).select(COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_each(docs.select(COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the spans that benchmark items cover; those covered by
    more than half go whole."""
    found = decontaminate(docs.select(COLUMNS), load_table(spark, sf_dir, "benchmark"))
    hit = F.col("n_hit") > 0
    return (found.where(~F.col("refused"))
            .withColumn("n_chars", F.when(hit, F.length("clean").cast("long")).otherwise(F.col("n_chars")))
            .withColumn("text", F.col("clean")).select(COLUMNS))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out towards the sources' weights."""
    return mix(docs.select(COLUMNS)).select(COLUMNS)


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Record files and their index; one row per record, read back from them."""
    path = scratch_path(spark, "pipeline-records")
    write_records(docs, path)
    return (index_records(spark, path, path + "-index")
            .select("doc_id", "start", "n_tokens", "ids_crc32"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("token_records", token_records),
]

#: SQL has neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
