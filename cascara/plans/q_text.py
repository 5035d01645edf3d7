"""Queries for token counting (S1 input shape, B1-B4)."""

from __future__ import annotations

from cascara.operators import text as X
from cascara.plans import standins as S
from cascara.plans.registry import query

# DuckDB spelling of "strip, then split on single spaces" for the stand-in
# text, which holds no whitespace other than spaces and newlines.
_TOK = "string_split(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'), ' ')"
_LINES = "SELECT unnest(string_split(text, chr(10))) AS value FROM documents"
_TAGGED = ("SELECT CAST(ts AS DATE) AS day, event_type || ' #' || event_type || ' #u' || "
           "CAST(user_id AS VARCHAR) AS value FROM events")
_DAYS = "(SELECT min(CAST(ts AS DATE)) AS d1, min(CAST(ts AS DATE)) + 1 AS d2 FROM events)"


@query("explode_tokens", f"""
SELECT unnest({_TOK.format(c='value')}) AS token FROM ({_LINES})
""")
def q_explode_tokens(spark, d):
    return X.explode_tokens(S.doc_lines(spark, d))


@query("token_counts", f"""
SELECT token, CAST(count(*) AS BIGINT) AS count
FROM (SELECT unnest({_TOK.format(c='value')}) AS token FROM ({_LINES})) GROUP BY token
""")
def q_token_counts(spark, d):
    return X.token_counts(S.doc_lines(spark, d))


@query("prefix_token_counts", f"""
SELECT token, CAST(count(*) AS BIGINT) AS count
FROM (SELECT unnest({_TOK.format(c='value')}) AS token FROM ({_TAGGED}))
WHERE starts_with(token, '#') GROUP BY token
""")
def q_prefix_counts(spark, d):
    return X.prefix_token_counts(S.tagged_events(spark, d))


_DIFF = f"""
WITH t AS (
  SELECT day, unnest({_TOK.format(c='value')}) AS token FROM ({_TAGGED}) e, {_DAYS} dd
  WHERE day IN (dd.d1, dd.d2)),
c AS (
  SELECT token,
         CAST(count(*) FILTER (WHERE day = (SELECT d1 FROM {_DAYS})) AS BIGINT) AS count_day1,
         CAST(count(*) FILTER (WHERE day = (SELECT d2 FROM {_DAYS})) AS BIGINT) AS count_day2
  FROM t WHERE starts_with(token, '#') GROUP BY token)
"""


@query("count_diff", _DIFF + "SELECT token, count_day1, count_day2, count_day2 - count_day1 AS diff FROM c")
def q_count_diff(spark, d):
    d1, d2 = S.first_days(spark, d)
    return X.count_diff(S.tagged_events(spark, d), "day", d1, d2, ts_col="ts")


@query("count_diff_outer_join",
       _DIFF + "SELECT token, count_day1, count_day2, count_day2 - count_day1 AS diff FROM c")
def q_count_diff_oj(spark, d):
    d1, d2 = S.first_days(spark, d)
    return X.count_diff_outer_join(S.tagged_events(spark, d), "day", d1, d2, ts_col="ts")


@query("new_keys_only", _DIFF + "SELECT token, count_day2 FROM c WHERE count_day1 = 0 AND count_day2 > 0")
def q_new_keys(spark, d):
    d1, d2 = S.first_days(spark, d)
    return X.new_keys_only(S.tagged_events(spark, d), "day", d1, d2, ts_col="ts")


@query("stream_prefix_token_counts", f"""
SELECT token, CAST(count(*) AS BIGINT) AS count
FROM (SELECT unnest({_TOK.format(c='value')}) AS token FROM ({_TAGGED}))
WHERE starts_with(token, '#') GROUP BY token
""")
def q_stream_prefix_counts(spark, d):
    import os

    from pyspark.sql import functions as F

    from cascara.streaming import prefix_counts_stream, run_available

    schema = spark.read.parquet(os.path.join(d, "events.parquet")).schema
    # A file stream watches a folder; the glob keeps it to the events table.
    ev = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    lines = ev.select(F.concat_ws(" ", "event_type", F.concat(F.lit("#"), "event_type"),
                                  F.concat(F.lit("#u"), F.col("user_id").cast("string"))).alias("value"))
    return run_available(prefix_counts_stream(lines), "stream-tags")


@query("count_diff_day_files", _DIFF + "SELECT token, count_day1, count_day2, count_day2 - count_day1 AS diff FROM c")
def q_count_diff_day_files(spark, d):
    """B3 on the reference's input layout, one folder per day: the tagged
    lines are written partitioned by day, and the day filter prunes every
    other day's folder before any file is opened (PartitionFilters)."""
    from cascara.session import scratch_path

    path = scratch_path(spark, "tagged-by-day")
    d1, d2 = S.first_days(spark, d)
    S.tagged_events(spark, d).select("day", "value").write.partitionBy("day").parquet(path)
    return X.count_diff(spark.read.parquet(path), "day", d1, d2)
