"""Operator 8 (DataFrame functions only): mix sources to target weights.

Words are summed per source, the whole is shared out by weight, no source
beyond ``max_repeat`` times its size, and each document is emitted
floor(rate) times plus once more if a hash of its id falls below the fraction.
Each source rotates its documents' hashes so that what it takes is near its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cascara.llm.common import WORD, hidden, load_table, materialize, query, text_or_empty
from cascara.operators.ranking import global_row_number

#: Targets are broadcast up to this many bytes (summed first), else joined.
BROADCAST_BYTES = 8 << 20
#: Rotations tried for each source, by equal parts of the draws' range.
SHIFTS = 32
_RANGE = 1 << 32


def sums_before(df: DataFrame, order: list[Column], names: dict[str, str]) -> DataFrame:
    """``df`` plus, for each column and name of ``names``, the column's sum over
    all rows earlier in ``order`` (a total order; 0 for the first). An action: rows
    are written once with their range's number, summed inside the ranges, and one
    row per range gives what is before it."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.repartitionByRange(n, *order)
                         .withColumn("_pid", F.spark_partition_id()), "ranged")

    def before(c: str, window) -> Column:
        return F.coalesce(F.sum(c).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    inside = Window.partitionBy("_pid").orderBy(*order)
    sizes = ranged.groupBy("_pid").agg(*[F.sum(c).alias(f"_sum_{x}") for c, x in names.items()])
    offsets = sizes.select("_pid", *[before(f"_sum_{x}", Window.orderBy("_pid")).alias(f"_off_{x}")
                                     for x in names.values()])
    return (ranged.withColumns({x: before(c, inside) for c, x in names.items()})
            .join(F.broadcast(offsets), "_pid")
            .withColumns({x: F.col(x) + F.col(f"_off_{x}") for x in names.values()})
            .drop("_pid", *[f"_off_{x}" for x in names.values()]))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], max_repeat: int) -> DataFrame:
    """(source, source_size, target): the fixed point of giving every source
    its weight's share and resharing what exceeds ``max_repeat`` x its size.

    In the fixed point a source has min(cap, weight x level). Sources in
    ascending order of cap / weight fill up first, so the level follows from
    running sums: with the first j capped, level_j = (total - caps) / (weights
    left); j is the first at which the next source stays below its cap.
    ``sizes`` has one row per source. Numbers and running sums are made over
    ranges of the sources; only totals and the level itself are single rows.
    """
    numbered = global_row_number(sizes, [F.col("source").asc_nulls_last()], "number")
    w = F.element_at(F.array(*map(F.lit, weights)),
                     ((F.col("number") - 1) % len(weights) + 1).cast("int"))
    s = materialize(numbered.withColumns({"w": w.cast("long"), "cap": F.col("source_size") * max_repeat})
                    .drop("number"), "source-weights")
    words, weight = (F.lit(x or 0).cast("long") for x in s.agg(F.sum("source_size"), F.sum("w")).first())
    s = sums_before(s, [F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()],
                    {"cap": "caps_before", "w": "w_before"})
    # left, wleft: what remains, in words and weights, with all before capped.
    s = s.withColumns({"left": words - F.col("caps_before"), "wleft": weight - F.col("w_before")})
    # The source is capped if the level of those left would reach its cap.
    s = s.withColumn("full", F.col("left") * F.col("w") >= F.col("cap") * F.col("wleft"))
    s = materialize(s, "source-levels")
    first = s.agg(F.min(F.when(~F.col("full"), F.struct((F.col("cap") / F.col("w")).alias("r"),
                                                        F.col("left"), F.col("wleft"))))).first()[0]
    level = F.struct(*(F.lit(first[c]).cast("long").alias(c) for c in ("left", "wleft"))) if first else F.lit(
        None).cast("struct<left:bigint,wleft:bigint>")
    return s.withColumn("level", level).select(
        "source", "source_size",
        F.when(F.col("full") | F.col("level").isNull(), F.col("cap").cast("double"))
        .otherwise((F.col("level.left") * F.col("w")).cast("double")
                   / F.col("level.wleft").cast("double")).alias("target"))


def _copies(draw: Column, shift: Column, target: Column, source_size: Column) -> Column:
    """floor(rate), and one more if the shifted draw is below the fraction."""
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    place = F.pmod(draw + shift.cast("long") * (_RANGE // SHIFTS), F.lit(_RANGE)) / F.lit(_RANGE).cast("double")
    return F.floor(rate) + (place < rate - F.floor(rate)).cast("long")


def with_shifts(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` plus shift: of ``SHIFTS`` rotations of the draws the one by
    which a source takes nearest to its target; the least of equal ones.
    ``rows``: (_source, draw, size). Totals are combined before the shuffle."""
    tried = (rows.join(targets, F.col("source").eqNullSafe(F.col("_source")))
             .withColumn("shift", F.explode(F.sequence(F.lit(0), F.lit(SHIFTS - 1)))))
    taken = F.col("size") * _copies(F.col("draw"), F.col("shift"), F.col("target"), F.col("source_size"))
    keys = ["source", "source_size", "target"]
    return (tried.groupBy(*keys, "shift").agg(F.sum(taken).alias("taken"))
            .groupBy(*keys).agg(F.min(F.struct(F.abs(F.col("taken") - F.col("target")).alias("miss"),
                                               "shift")).alias("best"))
            .select(*keys, F.col("best.shift").alias("shift")))


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_repeat: int = 3,
             seed: int = 8, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """``docs`` plus size, source_size, target and copies.

    Every document draws a number by the hash of its id and the seed. A source
    of few or very uneven documents can miss its target by far with any one
    seed, so each source rotates its draws by the shift that comes nearest.

    A null text has size 0; a null source is a source, ordered last; a source
    without words has target 0. Repeated rows draw the same number, and rows
    without an id draw by their text, so reruns agree. Columns named like the
    results are replaced. An empty table gives an empty result.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null"), F.md5(text_or_empty(text_col))))
    draw = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{seed}"))), 1, 8), 16, 10).cast("long")
    rows = materialize(docs.select(F.col(source_col).alias("_source"), draw.alias("draw"),
                                   size.alias("size")), "mix-draws")
    sizes = rows.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(materialize(sizes, "source-sizes"), weights, max_repeat),
                          "mix-targets")
    held = targets.agg(F.sum(40 + F.coalesce(F.octet_length(F.col("source").cast("string")), F.lit(0)))).first()[0]
    few = (held or 0) <= BROADCAST_BYTES
    targets = materialize(with_shifts(rows, F.broadcast(targets) if few else targets), "mix-shifts")
    names = {c: hidden(c) for c in targets.columns}
    targets = targets.withColumnsRenamed(names)
    if few:
        targets = F.broadcast(targets)
    source, source_size, target, shift = map(F.col, names.values())
    return (docs.drop("size", "source_size", "target", "copies")
            .join(targets, F.col(source_col).eqNullSafe(source))
            .withColumns({"size": size, "source_size": source_size, "target": target,
                          "copies": _copies(draw, shift, target, source_size)})
            .drop(*names.values()))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as ``mix_plan`` says, with
    its number ``copy`` from 0."""
    plan = mix_plan(docs, **options).where("copies > 0")
    return (plan.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
            .drop("size", "source_size", "target", "copies"))


_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), n AS (
  SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS w,
         3 * source_size AS cap FROM s
), f AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::BIGINT AS words_left,
         (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::BIGINT AS w_left
  FROM n WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), q AS (
  SELECT *, words_left * w >= cap * w_left AS is_full FROM f
), lv AS (
  SELECT words_left AS l, w_left AS wl FROM q WHERE NOT is_full ORDER BY cap / w, words_left, w_left LIMIT 1
), t AS (
  SELECT source, source_size,
         CASE WHEN is_full OR wl IS NULL THEN cap::DOUBLE ELSE (l * w)::DOUBLE / wl::DOUBLE END AS target
  FROM q LEFT JOIN lv ON true
), r AS (
  SELECT doc_id, d.source, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null' || md5(coalesce(text, ''))) || ':8'), 1, 8))::BIGINT AS draw
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), a AS (
  SELECT *, (size * (floor(rate) + ((draw + shift * {_RANGE // SHIFTS}) % {_RANGE} / {_RANGE}::DOUBLE
                                    < rate - floor(rate))::INT))::BIGINT AS taken
  FROM r, range({SHIFTS}) AS g(shift)
), b AS (
  SELECT source, shift FROM a GROUP BY source, shift
  QUALIFY row_number() OVER (PARTITION BY source
                             ORDER BY abs(sum(taken)::BIGINT - any_value(target)), shift) = 1
)
SELECT doc_id, size, source_size, target, taken
FROM a JOIN b ON a.source IS NOT DISTINCT FROM b.source AND a.shift = b.shift
"""


@query("op8_source_mix", _SQL)
def op8(spark: SparkSession, d: str) -> DataFrame:
    docs = load_table(spark, d, "documents").select("doc_id", "text", "source")
    return mix_plan(docs).select("doc_id", "size", "source_size", "target",
                                 (F.col("copies") * F.col("size")).alias("taken"))
