"""Operator 4: quality rules with risk-controlled cutoffs.

Each rule is a ratio of counts with a fixed ladder of cutoffs, loosest first. A
step of the ladder sets the cutoffs of all rules at once, so the documents that
any rule rejects are counted together and the limit is not split between rules.
For every stratum the labelled good documents tell how many a step would reject
wrongly. A step may be used if the exact binomial test refuses, at the level left
after correction, that its false rejection rate exceeds the limit; the ladder is
walked until the first step fails (fixed-sequence testing, so walking costs no
level), and the level is divided by the strata (Bonferroni). Then, with confidence
1 - ``delta``, in every stratum at most ``alpha`` of good documents are rejected by
the cutoffs. Equal texts are one draw, whatever their ids and number.
"""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascara.llm.common import hidden, load_table, map_rows, materialize, query

#: Cutoffs are broadcast up to this many bytes (summed first), else joined.
BROADCAST_BYTES = 8 << 20

_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
# The symbols counted.
_SYMBOLS = "#*$%&|<>"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


STEPS = 48


def _ladder(loose: float, tight: float) -> tuple[float, ...]:
    return tuple(round(loose + (tight - loose) * i / (STEPS - 1), 6) for i in range(STEPS))


#: rule -> (value, cutoffs from loosest to tightest); a value above rejects.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "long_words": ("try_divide(word_chars, n_words)", _ladder(40, 6)),
    "short_words": ("- try_divide(word_chars, n_words)", _ladder(-1, -5)),
    "symbols": ("try_divide(n_symbols, n_words)", _ladder(3, 0.02)),
    "same_lines": ("try_divide(n_dup_lines, n_lines)", _ladder(0.95, 0.02)),
    "repeats": ("try_divide(n_repeat_words, n_words)", _ladder(0.95, 0.02)),
}


def _repeat_words(words: list[str]) -> int:
    """Words in 3-word windows that occur twice or more in the text."""
    if len(words) < 4:
        return 0
    ids: dict[str, int] = {}
    n = [ids.setdefault(w, len(ids)) for w in words]
    windows = list(zip(n, n[1:], n[2:]))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    twice = {w for i, w in enumerate(windows) if first.setdefault(w, i) != i}
    covered = total = 0  # covered: end of the last window counted
    for i, w in enumerate(windows):
        if w in twice:
            total += i + 3 - max(covered, i)
            covered = i + 3
    return total


def base_counts(text: str | None) -> tuple[int, ...]:
    """The counts named in ``_COUNTS`` of one whole text; null is empty."""
    text = text or ""
    words = _WORD.findall(text)
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    return (len(words), sum(map(len, words)), sum(map(text.count, _SYMBOLS)), len(lines),
            len(lines) - len(set(lines)), _repeat_words(words))


def text_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with the base counts."""
    rest = [c for c in docs.columns if c not in (text_col, *_COUNTS)]
    packed = docs.select(F.struct(F.lit(True).alias(hidden("row")), *rest).alias("row"),
                         F.col(text_col).alias("text"))

    def run(batch):
        found = list(zip(*map(base_counts, batch["text"].to_pylist())))
        yield {"row": batch["row"], **dict(zip(_COUNTS, map(list, found)))}

    row_type = packed.schema["row"].dataType.simpleString()
    out = map_rows(packed, run, f"row {row_type}, " + ", ".join(f"{c} long" for c in _COUNTS))
    return out.select(*[F.col("row")[c].alias(c) for c in rest], *_COUNTS)


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) of n draws, summed exactly in logarithms."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
            + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def choose_cutoff(good: list[int], bad: list[int], alpha: float, level: float,
                  cost: float) -> int:
    """The step of the ladder to use, or -1 for none.

    ``good[e]`` and ``bad[e]`` count documents that exceed the e tightest
    cutoffs and no other: step i of n rejects those with e >= n - i. Of the
    steps the test allows, the one that rejects most bad documents, less
    ``cost`` for each good one; ties go to the loosest.
    """
    n, total = len(good) - 1, sum(good)
    best, at, g, b = 0.0, -1, 0, 0
    for i in range(n):
        g, b = g + good[n - i], b + bad[n - i]
        # The same as a Clopper-Pearson upper bound above alpha.
        if not total or binomial_cdf(g, total, alpha) > level:
            break
        if b - cost * g > best:
            best, at = b - cost * g, i
    return at


def fit_cutoffs(counts: DataFrame, alpha: float = 0.05, delta: float = 0.05,
                cost: float = 10.0) -> DataFrame:
    """(stratum, step) of the strata whose rules are in use: the step of every
    rule's ladder. ``counts`` has stratum, good and the base counts of the labelled
    holdout, one row a draw, without failed documents.

    Strata too small to guarantee anything get no step. The cost of a good document
    steers the choice only; the guarantee does not depend on it.
    """
    strata = counts.select("stratum").distinct().count()
    level = delta / max(1, strata)

    def exceeded(value: str, ladder: tuple[float, ...]):
        return F.aggregate(F.array(*map(F.lit, ladder)), F.lit(0),
                           lambda n, cut: n + F.coalesce((F.expr(value) > cut).cast("int"), F.lit(0)))

    table = (counts.select("stratum", "good", F.greatest(*[exceeded(*v) for v in RULES.values()]).alias("exceeded"))
             .groupBy("stratum", "exceeded")
             .agg(F.sum(F.col("good").cast("long")).alias("good"),
                  F.sum((~F.col("good")).cast("long")).alias("bad")))

    def choose(t: pd.DataFrame) -> pd.DataFrame:  # one row per step at most
        good, bad = [0] * (STEPS + 1), [0] * (STEPS + 1)
        for e, g, b in zip(t["exceeded"], t["good"], t["bad"]):
            good[e], bad[e] = int(g), int(b)
        at = choose_cutoff(good, bad, alpha, level, cost)
        return t[["stratum"]].head(int(at >= 0)).assign(step=at)

    kind = counts.schema["stratum"].dataType.simpleString()
    return table.groupBy("stratum").applyInPandas(choose, f"stratum {kind}, step int")


def judge(docs: DataFrame, labels: DataFrame, stratum_col: str = "lang", id_col: str = "doc_id",
          text_col: str = "text", good_col: str = "quality", alpha: float = 0.05,
          delta: float = 0.05, cost: float = 10.0) -> DataFrame:
    """``docs`` without the text, plus the base counts, base_failed, broken
    (sorted names of the rules whose cutoff is exceeded) and kept.

    base_failed: under 50 words, or over half of them in repeated 3-word
    windows. A null text is empty and fails. A null stratum is a stratum. A
    document with several labels is good if all of them say 1; null labels are
    no labels; labels of unknown documents are ignored. Labelled documents of
    equal text in a stratum are one draw, good if all of them are. Without labels
    there are no cutoffs. Repeated rows are all judged. Columns named like the
    results are replaced.
    """
    digest, stratum, step = hidden("digest"), hidden("stratum"), hidden("step")
    docs = docs.drop("base_failed", "broken", "kept").withColumn(digest, F.sha2(F.coalesce(text_col, F.lit("")), 256))
    counts = text_counts(docs, text_col)
    counts = materialize(counts.withColumn("base_failed", (F.col("n_words") < 50) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words"))), "text-counts")
    known = (labels.select(F.col(id_col).alias("_id"), F.col(good_col).alias("_good"))
             .where("_id IS NOT NULL AND _good IS NOT NULL")
             .groupBy("_id").agg((F.min("_good") == 1).alias("good")))
    holdout = (counts.where(~F.col("base_failed"))
               .select(F.col(id_col).alias("_id"), F.col(stratum_col).alias("stratum"), F.col(digest).alias("_text"),
                       *_COUNTS)
               .join(known, "_id")
               # Equal texts have equal counts.
               .groupBy("stratum", "_text").agg(F.min("good").alias("good"), *[F.max(c).alias(c) for c in _COUNTS]))
    cutoffs = fit_cutoffs(materialize(holdout.drop("_text"), "holdout"), alpha, delta, cost)
    cutoffs = materialize(cutoffs.select(F.col("stratum").alias(stratum), F.col("step").alias(step)), "cutoffs")
    size = cutoffs.agg(F.sum(16 + F.coalesce(F.octet_length(F.col(stratum).cast("string")), F.lit(0)))).first()[0]
    if (size or 0) <= BROADCAST_BYTES:
        cutoffs = F.broadcast(cutoffs)
    broken = F.array_compact(F.array(*[
        F.when(F.expr(value) > F.get(F.array(*map(F.lit, ladder)), F.col(step)), F.lit(r))
        for r, (value, ladder) in sorted(RULES.items())]))
    return (counts.join(cutoffs, F.col(stratum_col).eqNullSafe(F.col(stratum)), "left")
            .withColumn("broken", broken).drop(stratum, step, digest)
            .withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0)))


@query("op4_quality_rules")
def op4(spark: SparkSession, d: str) -> DataFrame:
    docs = load_table(spark, d, "documents").select("doc_id", "text", "lang")
    out = judge(docs, load_table(spark, d, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept", "broken")
