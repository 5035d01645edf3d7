"""Operator 7 (DataFrame functions only): cross-site boilerplate lines.

A HyperLogLog sketch of the sites of every line hash, merged by aggregation,
settles most lines; those whose estimate lies near the threshold are counted
exactly. Lines on at least ``min_sites`` sites leave every document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascara.llm.common import hidden, load_table, materialize, query

# The white space that does not count at a line's ends.
_BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


def _trim(line):
    return F.btrim(line, F.lit(_BLANK))


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _key(line):
    """128 bits of the line without the white space around it; null if blank."""
    trimmed = _trim(line)
    return F.when(trimmed != "", F.struct(
        F.xxhash64(trimmed).alias("a"), F.xxhash64(F.lit(7), trimmed).alias("b")))


def common_lines(docs: DataFrame, min_sites: int, lg_k: int = 9, text_col: str = "text",
                 site_col: str = "source") -> DataFrame:
    """The keys (a, b) of lines that occur on at least ``min_sites`` sites.

    ``lg_k`` sets the sketch's size (2^lg_k slots). Estimates within six
    standard errors of the threshold, and at least one whole site, are counted
    exactly over all rows. A null site is a site of its own.
    """
    error = 6 * 1.04 / 2 ** (lg_k / 2)
    lines = (docs.select(F.coalesce(F.xxhash64(site_col), F.lit(0)).alias("site"),
                         F.explode(F.transform(_lines(F.col(text_col)), _key)).alias("k"))
             .where("k IS NOT NULL").select("k.a", "k.b", "site"))
    # A line seen fewer times than min_sites cannot have that many sites.
    seen = (lines.groupBy("a", "b")
            .agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("site", lg_k).alias("sketch"))
            .where(F.col("n") >= min_sites)
            .select("a", "b", F.hll_sketch_estimate("sketch").alias("sites")))
    seen = materialize(seen.where(F.col("sites") >= min(min_sites * (1 - error), min_sites - 1)),
                       "line-sites")
    near = F.col("sites") <= max(min_sites * (1 + error), min_sites + 1)
    exact = (lines.join(seen.where(near).select("a", "b"), ["a", "b"], "left_semi").distinct()
             .groupBy("a", "b").agg(F.count(F.lit(1)).alias("sites"))
             .where(F.col("sites") >= min_sites).select("a", "b"))
    return materialize(seen.where(~near).select("a", "b").unionAll(exact), "common-lines")


def remove_common_lines(docs: DataFrame, min_sites: int, lg_k: int = 9, id_col: str = "doc_id",
                        text_col: str = "text", site_col: str = "source") -> DataFrame:
    """``docs`` with the text's boilerplate lines removed, and n_lines (lines
    that are not blank) and n_removed.

    A null text stays null with 0 lines. Blank lines and white space around a
    line do not count as content; blank lines stay. Repeated rows are all kept.
    Columns named n_lines or n_removed are replaced. An empty table gives an
    empty result.
    """
    common = common_lines(docs, min_sites, lg_k, text_col, site_col)
    row_name, drop_name, kept_name = map(hidden, ("row", "drop", "kept"))
    text = F.col(text_col)
    row = F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"))
    drop = (docs.select(row.alias(row_name), F.explode(F.array_distinct(F.transform(_lines(text), _key))).alias("k"))
            .where("k IS NOT NULL").join(common.select(F.struct("a", "b").alias("k")), "k")
            .groupBy(row_name).agg(F.collect_set("k").alias(drop_name)))
    keyed = docs.drop("n_lines", "n_removed").withColumn(row_name, row)
    joined = (keyed.join(drop, keyed[row_name].eqNullSafe(drop[row_name]), "left")
              .drop(drop[row_name]))
    lines = F.transform(_lines(text), lambda x: F.struct(x.alias("line"), _key(x).alias("k")))
    gone = F.coalesce(F.col(drop_name), F.array().cast("array<struct<a:bigint,b:bigint>>"))
    kept = F.filter(lines, lambda x: x["k"].isNull() | ~F.array_contains(gone, x["k"]))
    has_drop = F.col(drop_name).isNotNull()
    return (joined
            .withColumns({
                "n_lines": F.size(F.filter(_lines(text), lambda x: _trim(x) != "")).cast("long"),
                kept_name: F.when(has_drop, F.transform(kept, lambda x: x["line"]))})
            .withColumns({
                "n_removed": F.when(has_drop, F.size(_lines(text)) - F.size(kept_name))
                .otherwise(0).cast("long"),
                text_col: F.when(has_drop, F.array_join(kept_name, "\n")).otherwise(text)})
            .drop(row_name, drop_name, kept_name))


MIN_SITES = 5

_SQL = rf"""
WITH l AS (
  SELECT rowid AS r, doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
  FROM (SELECT *, row_number() OVER () AS rowid FROM documents)
), k AS (
  SELECT *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS key FROM l
), c AS (
  SELECT key FROM k WHERE key <> '' GROUP BY key
  HAVING count(DISTINCT coalesce(source, chr(0) || 'none')) >= {MIN_SITES}
), m AS (
  SELECT k.*, c.key IS NOT NULL AS gone FROM k LEFT JOIN c USING (key)
)
SELECT doc_id, count(*) FILTER (key <> '') AS n_lines, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""


@query("op7_line_dedup", _SQL)
def op7(spark: SparkSession, d: str) -> DataFrame:
    docs = load_table(spark, d, "documents").select("doc_id", "text", "source")
    return remove_common_lines(docs, MIN_SITES).select(
        "doc_id", "n_lines", "n_removed",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
