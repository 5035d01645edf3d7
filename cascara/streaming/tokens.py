"""Hashtag (prefixed-token) counting over a stream of text lines (B2 on a
stream: lines arrive as new files, e.g. one file per day).

The counting operator is the batch one, unchanged: a streaming DataFrame goes
through the same ``explode`` + ``groupBy``. State holds one running count per
distinct token, so it is bounded by the vocabulary, not by the stream length.
Results leave through ``foreachBatch``: every micro-batch of the complete
result gets a parquet folder of its own below the shared folder, the last of
which is the result, so nothing is collected to the driver. The checkpoint location makes the query restartable
after a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascara.operators.text import prefix_token_counts
from cascara.session import scratch_path


def prefix_counts_stream(lines: DataFrame, text_col: str = "value", prefix: str = "#") -> DataFrame:
    """Running (token, count) of a streaming DataFrame of lines."""
    return prefix_token_counts(lines, text_col, prefix, sort=False)


def run_available(counts: DataFrame, name: str, out: str | None = None,
                  checkpoint: str | None = None) -> DataFrame:
    """Process everything available now (``availableNow`` trigger), write the
    complete result as parquet, and return it as a batch DataFrame.

    Passing the same ``out`` and ``checkpoint`` again resumes the query: only
    files that arrived since the last run are read, and the running counts
    continue from the saved state."""
    spark: SparkSession = counts.sparkSession
    out = out or scratch_path(spark, f"{name}-out")
    ckpt = checkpoint or scratch_path(spark, f"{name}-ckpt")

    def write(batch: DataFrame, epoch: int) -> None:
        # A folder per epoch: a failed write leaves the last whole one as it is,
        # and a repeated epoch writes its own folder again.
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    q = (counts.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    done = spark.read.parquet(out)
    return done.where(F.col("epoch") == done.agg(F.max("epoch")).scalar()).drop("epoch")
