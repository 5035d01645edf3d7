"""Operator 1: token counts through a digest cache.

The cache is a parquet table keyed by (tokenizer digest, content digest). Texts
are reduced to distinct contents with a map-side combine, the contents that the
cache lacks are encoded, their counts appended, and the documents joined to the
counts by digest. A text crosses the network at most once, one copy per content.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascara.llm.common import hidden, load_table, map_rows, materialize, query, scratch_path, text_or_empty
from cascara.llm.encode import default_tokenizer, encoder, in_slices, tokenizer_digest

_CACHE = "content binary, n_tokens long"


def _cache(spark: SparkSession, path: str, tokenizer: str) -> str:
    """The folder of one tokenizer version; it exists afterwards."""
    folder = f"{path.rstrip('/')}/tokenizer={tokenizer_digest(tokenizer)}"
    spark.createDataFrame([], _CACHE).coalesce(1).write.mode("append").parquet(folder)
    return folder


def add_missing(docs: DataFrame, folder: str, tokenizer: str, text_col: str = "text") -> None:
    """Encode the distinct contents that the cache lacks and append them."""
    spark = docs.sparkSession
    known = spark.read.schema(_CACHE).parquet(folder).select("content").distinct()
    text = text_or_empty(text_col)
    missing = (docs.select(F.unhex(F.sha2(text, 256)).alias("content"), text.alias("text"))
               .groupBy("content").agg(F.first("text").alias("text"))
               .join(known, "content", "left_anti"))

    def count(batch):
        keys, texts = batch["content"].to_pylist(), batch["text"].to_pylist()
        for a, b in in_slices(texts):
            yield {"content": keys[a:b],
                   "n_tokens": encoder(tokenizer).count(texts[a:b])}

    map_rows(missing, count, _CACHE, encodes=True).write.mode("append").parquet(folder)


def token_counts(docs: DataFrame, cache_path: str, tokenizer: str | None = None,
                 text_col: str = "text") -> DataFrame:
    """``docs`` plus n_bytes (UTF-8) and n_tokens of every whole text.

    A null text is the empty text (0 bytes, 0 tokens). Repeated rows keep their
    number; equal texts share one cache entry. Columns of ``docs`` named like
    the results are replaced. An empty table gives an empty result and still
    creates the cache. Content is taken as it is: any normalisation that
    changes a text could change its count.
    """
    tokenizer = tokenizer or default_tokenizer()
    spark = docs.sparkSession
    folder = _cache(spark, cache_path, tokenizer)
    add_missing(docs, folder, tokenizer, text_col)
    # Two writers may both have appended a content: one row per key.
    content = hidden("content")
    counts = materialize(spark.read.schema(_CACHE).parquet(folder)
                         .groupBy(F.col("content").alias(content))
                         .agg(F.max("n_tokens").alias("n_tokens")), "token-counts")
    text = text_or_empty(text_col)
    return (docs.withColumns({"n_bytes": F.octet_length(text).cast("long"),
                              content: F.unhex(F.sha2(text, 256))})
            .drop("n_tokens").join(counts, content).drop(content))


@query("op1_token_counts")
def op1(spark: SparkSession, d: str) -> DataFrame:
    docs = load_table(spark, d, "documents").select("doc_id", "text")
    out = token_counts(docs, scratch_path(spark, "token-cache"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))
