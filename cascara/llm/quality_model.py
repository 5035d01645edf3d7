"""Operator 9: a quality classifier by co-training.

Two views of a document, its words (content) and the page around them (source,
language, size, layout), each get a logistic model on binary tokens. Fitted on
labelled documents, either model labels the unlabelled ones it is sure of for
the other, over some rounds. Both are calibrated on labelled documents they
have not seen, combined there, and score every document. A few words make a
document toxic, so a model of its own looks for them. Both cutoffs are chosen on
the unseen labelled documents, by the share of good ones they may cost.

Fitting takes at most ``max_labelled`` labelled documents, by the hash of their
id. Pseudo-labels are looked for among all others: each round scores them in a
Spark pass, and Spark picks the ``grow`` surest for each view and class. Only
those rows join the fit, and the features are screened again with them, by counts
that Spark aggregates. So what reaches the driver is at most ``max_labelled`` + 4 x
``rounds`` x ``grow`` rows of at most ``max_tokens`` feature numbers. The last
pass scores every whole text once more.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascara.llm.common import beside_text, load_table, map_rows, materialize, query

VIEWS = ("content", "layout")
_MARKS = "#*$%&|<>!?@{}=_~^+/\\"
# ASCII punctuation to blanks: a word's core is the same with a full stop.
_CORE = bytes(32 if 0x21 <= b <= 0x2F or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7E
              else b for b in range(256))

_CAPITALS = bytes(range(0x41, 0x5B))


def _step(x: float) -> int:
    """Half powers of two."""
    return int(round(2 * math.log2(x))) if x > 0 else -99


def content_tokens(text: str) -> list[int]:
    """Hashes of the distinct words, and of how much of the text is marks,
    capitals, digits and repetition."""
    raw = text.encode()
    words = raw.lower().translate(_CORE).split()
    distinct = set(words)
    n = len(words) or 1
    # A blank cannot occur in a word, so these never meet one.
    stats = [b"mark %s %d" % (m.encode(), _step(text.count(m) / n)) for m in _MARKS if m in text]
    upper = len(raw) - len(raw.translate(None, _CAPITALS))
    stats += [b"upper %d" % int(20 * upper / (len(raw) or 1)),
              b"distinct %d" % int(20 * len(distinct) / n), b"words %d" % min(6, _step(n + 1) // 2)]
    return list(map(crc32, distinct)) + list(map(crc32, stats))


def layout_tokens(text: str, source: str | None, lang: str | None, n_chars: int | None) -> list[int]:
    lines = text.split("\n")
    filled = [x for x in lines if x.strip()]
    stats = [f"source {source}", f"lang {lang}", f"chars {_step(n_chars or 0)}",
             f"lines {_step(len(filled))}", f"blank {len(lines) > len(filled)}",
             f"mean {_step(len(text) / (len(filled) or 1))}",
             f"longest {_step(max(map(len, filled), default=0))}",
             f"same {int(10 * (1 - len(set(filled)) / (len(filled) or 1)))}"]
    return [crc32(s.encode()) for s in stats]


def _tokens(batch) -> dict[str, list[list[int]]]:
    texts = [t or "" for t in batch["_text"].to_pylist()]
    return {"content": [content_tokens(t) for t in texts],
            "layout": [layout_tokens(*row) for row in zip(
                texts, *(batch[c].to_pylist() for c in ("_source", "_lang", "_n_chars")))]}


class Logistic:
    """Weights of binary features, fitted by Adam on all rows with a ridge."""

    def __init__(self, n: int):
        self.w, self.b = np.zeros(n), 0.0

    def margin(self, x: list[np.ndarray]) -> np.ndarray:
        return np.array([self.w[i].sum() for i in x]) + self.b

    def fit(self, x: list[np.ndarray], y: np.ndarray, ridge: float = 1e-4, rounds: int = 250,
            rate: float = 0.05) -> "Logistic":
        cols = np.concatenate(x) if x else np.zeros(0, dtype=np.int64)
        rows = np.repeat(np.arange(len(x)), [len(i) for i in x])
        p = np.zeros(len(self.w) + 1)
        m, v = np.zeros_like(p), np.zeros_like(p)
        for t in range(1, rounds + 1):
            z = np.bincount(rows, weights=p[cols], minlength=len(x)) + p[-1]
            r = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
            g = np.append(np.bincount(cols, weights=r[rows], minlength=len(self.w)) + ridge * p[:-1], r.sum())
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            p -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-12)
        self.w, self.b = p[:-1], p[-1]
        return self


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _line(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients (one per column of z, then the constant) of a logistic
    regression by Newton's method, with a small ridge."""
    a = np.column_stack([z, np.ones(len(z))])
    c = np.zeros(a.shape[1])
    for _ in range(30):
        p = _sigmoid(a @ c)
        grad = a.T @ (p - y) + 1e-2 * c
        c -= np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(len(c)), grad)
    return c


@dataclass
class Model:
    """What scoring needs; its size is bounded by ``max_tokens``."""

    tokens: dict[str, np.ndarray]  # sorted token hashes of each view
    views: dict[str, Logistic]
    lines: dict[str, np.ndarray]  # calibration of each view
    blend: np.ndarray
    reject_below: float
    toxic: Logistic | None  # on tokens["toxic"] of the content view
    toxic_line: np.ndarray
    toxic_above: float

    def numbers(self, view: str, tokens: list[int]) -> np.ndarray:
        return numbers(self.tokens[view], tokens)

    def toxicity(self, content: list[list[int]]) -> np.ndarray:
        if self.toxic is None:
            return np.zeros(len(content))
        z = self.toxic.margin([self.numbers("toxic", t) for t in content])
        return _sigmoid(z * self.toxic_line[0] + self.toxic_line[1])

    def score(self, x: dict[str, list[np.ndarray]]):
        z = {v: self.views[v].margin(x[v]) * self.lines[v][0] + self.lines[v][1] for v in VIEWS}
        both = np.column_stack([z[v] for v in VIEWS])
        return {**{v: _sigmoid(z[v]) for v in VIEWS},
                "score": _sigmoid(both @ self.blend[:-1] + self.blend[-1])}


def cutoff(scores: np.ndarray, limit: float, unknown: float = 0.5) -> float:
    """The highest cutoff by which a good document, drawn like those of
    ``scores``, falls below it with a chance of at most ``limit``: the k-th least
    score of n, as the chance is at most k / (n + 1). ``unknown`` if there are
    too few scores to tell."""
    k = int(limit * (len(scores) + 1) + 1e-9)
    return float(np.sort(scores)[k - 1].round(6)) if k else unknown


def numbers(lexicon: np.ndarray, tokens: list[int]) -> np.ndarray:
    """Positions in the sorted lexicon of those tokens that it has."""
    t = np.unique(np.array(tokens, dtype=np.int64))
    at = np.searchsorted(lexicon, t)
    at[at == len(lexicon)] = 0
    return at[lexicon[at] == t] if len(lexicon) else at[:0]


def lexicon(sample: DataFrame, view: str, max_tokens: int, least: int, z: float) -> np.ndarray:
    """Tokens whose share among good training documents differs from that among
    bad ones by ``z`` standard errors; the most telling if there are more than
    ``max_tokens``."""
    train = sample.where("part = 'train'")
    n = train.agg(F.sum("y"), F.sum(1 - F.col("y"))).first()
    good, bad = float(n[0] or 0), float(n[1] or 0)
    if not good or not bad:
        return np.zeros(0, dtype=np.int64)
    share = (F.col("g") + F.col("b")) / (good + bad)
    error = F.sqrt(share * (1 - share) * (1 / good + 1 / bad) + 1e-12)
    rows = (train.select("y", F.explode(F.array_distinct(view)).alias("token")).groupBy("token")
            .agg(F.sum("y").alias("g"), F.sum(1 - F.col("y")).alias("b"))
            .where(F.col("g") + F.col("b") >= least)
            .withColumn("z", F.abs(F.col("g") / good - F.col("b") / bad) / error)
            .where(F.col("z") >= z).orderBy(F.desc("z"), "token").limit(max_tokens).collect())
    return np.array(sorted(r["token"] for r in rows), dtype=np.int64)


def teach(fit, surest, rounds: int):
    """Each round, either view hands the other its surest pseudo-labels:
    ``fit`` makes models from lists of (document, label) for each view, ``surest``
    such lists, by the view that is sure, from models and all handed over so far."""
    extra: dict[str, list[tuple[int, float]]] = {v: [] for v in VIEWS}
    models = fit(extra)
    for _ in range(rounds):
        found = surest(models, extra)
        if not any(found.values()):
            break
        for view, other in (VIEWS, VIEWS[::-1]):
            extra[other] = extra[other] + found[view]
        models = fit(extra)
    return models


def _features(docs: DataFrame, text_col: str, source_col: str, lang_col: str, chars_col: str):
    """The columns the views read, under names of their own."""
    return (F.col(text_col).alias("_text"), F.col(source_col).cast("string").alias("_source"),
            F.col(lang_col).cast("string").alias("_lang"), F.col(chars_col).cast("long").alias("_n_chars"))


def fit_model(docs: DataFrame, labels: DataFrame, good, toxic, id_col: str = "doc_id",
              text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
              chars_col: str = "n_chars", max_labelled: int = 20_000,
              max_tokens: int = 4_000, least: int = 4, z: float = 3.0, rounds: int = 3,
              grow: int = 500, sure: float = 0.97, good_loss: float = 0.01) -> Model | None:
    """None if the labels hold no good or no bad document."""
    order = F.md5(F.concat(F.col("_id").cast("string"), F.lit(":co-training")))
    known = (labels.select(F.col(id_col).alias("_id"), good.cast("int").alias("y"),
                           F.coalesce(toxic.cast("int"), F.lit(0)).alias("toxic"))
             .where("_id IS NOT NULL AND y IS NOT NULL")
             .groupBy("_id").agg(F.min("y").alias("y"), F.max("toxic").alias("toxic")))
    ids = docs.select(F.col(id_col).alias("_id")).where("_id IS NOT NULL").distinct()
    part = F.when(F.conv(F.substring("h", -4, 4), 16, 10) % 10 < 7, "train").otherwise("held")
    chosen = materialize(known.join(ids, "_id").withColumn("h", order).orderBy("h", "_id")
                         .limit(max_labelled).withColumn("part", part), "sample-ids")
    # Equal rows are one candidate: copies must not fill the places of a class.
    texts = docs.select(F.col(id_col).alias("_id"), *_features(docs, text_col, source_col, lang_col, chars_col))
    texts = texts.withColumn("key", F.xxhash64(*(
        x for c in texts.columns[1:] for x in (F.col(c).isNull(), F.col(c)))))
    # At most max_labelled ids: under 2 MB.
    rows = texts.join(F.broadcast(chosen), "_id")
    # Of several texts of one id that of least hash.
    rows = rows.groupBy("_id").agg(F.min_by(F.struct(*rows.columns[1:]), "key").alias("row")).select("_id", "row.*")
    arrays = "content array<long>, layout array<long>"

    def tokens(batch):
        yield {**{c: batch[c] for c in ("key", "h", "y", "part")}, "bad": batch["toxic"], **_tokens(batch)}

    sample = materialize(map_rows(rows, tokens, f"key long, h string, y int, part string, bad int, {arrays}"),
                         "sample")
    train = sample.where("part = 'train'")
    if len({r["y"] for r in train.select("y").distinct().collect()}) < 2:
        return None
    spark = docs.sparkSession
    handed: list[DataFrame] = []  # the tokens of each round's pseudo-labelled rows
    fetched: set[int] = set()
    lex: dict[str, np.ndarray] = {}

    def pick(frame: DataFrame, names: list[str], places: dict[str, str]):
        """The columns ``names`` and feature numbers in the lexicons of ``places``."""
        known_tokens = {v: lex[v] for v in places}

        def run(batch):
            yield {**{c: batch[c] for c in names}, **{
                v: [numbers(known_tokens[v], t) for t in batch[c].to_pylist()] for v, c in places.items()}}

        kinds = {f.name: f.dataType.simpleString() for f in frame.schema}
        got = map_rows(frame, run, ", ".join([f"{c} {kinds[c]}" for c in names] + [f"{v} array<int>" for v in places]))
        got = got.toPandas().sort_values(names[0], kind="stable")
        return got, {v: [np.asarray(a, dtype=np.int64) for a in got[v]] for v in places}

    def keys(pairs) -> DataFrame:
        return F.broadcast(spark.createDataFrame([(k, int(label)) for k, label in pairs], "key long, y int"))

    def fit(extra):
        taken = sorted({k for v in VIEWS for k, _ in extra[v]} - fetched)
        if taken:
            new = texts.join(keys((k, 0) for k in taken), "key").dropDuplicates(["key"])

            def run(batch):
                yield {"key": batch["key"], **_tokens(batch)}

            handed.append(materialize(map_rows(new, run, f"key long, {arrays}"), "pseudo-labelled"))
            fetched.update(taken)
        models = {}
        for v in VIEWS:
            both = train.select("h", "y", v)
            for frame in handed:
                both = both.unionByName(frame.join(keys(extra[v]), "key").select(
                    F.lpad(F.hex("key"), 16, "0").alias("h"), "y", v))
            lex[v] = lexicon(both.withColumn("part", F.lit("train")), v, max_tokens, least, z)
            got, x = pick(both, ["h", "y"], {v: v})
            models[v] = Logistic(len(lex[v])).fit(x[v], got["y"].to_numpy(dtype=float))
        return models

    def surest(models, extra):
        sent = spark.sparkContext.broadcast(({v: lex[v] for v in VIEWS}, models))
        edge = math.log(sure / (1 - sure))

        def run(batch):
            words, views = sent.value
            found = _tokens(batch)
            m = {v: views[v].margin([numbers(words[v], t) for t in found[v]]) for v in VIEWS}
            at = np.flatnonzero(np.maximum(*(np.abs(m[v]) for v in VIEWS)) >= edge)
            yield {"_id": batch["_id"].take(at), "key": batch["key"].take(at), **{v: m[v][at] for v in VIEWS}}

        kind = texts.schema["_id"].dataType.simpleString()
        done = keys((k, 0) for k in sorted({k for v in VIEWS for k, _ in extra[v]}))
        # Rows without an id have no label either.
        scored = (map_rows(texts, run, f"_id {kind}, key long, content double, layout double")
                  .join(known.select("_id"), "_id", "left_anti")
                  .join(F.broadcast(sample.select("key")), "key", "left_anti").join(done, "key", "left_anti")
                  .select("key", *VIEWS).distinct())
        scored = materialize(scored, "co-training")
        found = {v: [(r["key"], label) for label, c in ((1.0, F.col(v)), (0.0, -F.col(v)))
                     for r in scored.where(c >= edge).orderBy(c.desc(), "key").limit(grow).collect()]
                 for v in VIEWS}
        sent.unpersist()
        return found

    views = teach(fit, surest, rounds)
    lex["toxic"] = lexicon(sample.select("part", F.col("bad").alias("y"), "content"), "content",
                           max_tokens, least, z)
    got, numbered = pick(sample, ["h", "y", "part", "bad"],
                         {"content": "content", "layout": "layout", "toxic": "content"})
    parts = {p: np.flatnonzero(got["part"] == p) for p in ("train", "held")}
    x = {p: {v: [a[i] for i in at] for v, a in numbered.items()} for p, at in parts.items()}
    y = {p: got["y"].to_numpy(dtype=float)[at] for p, at in parts.items()}
    held = "held" if len(set(y["held"])) == 2 else "train"
    lines = {v: _line(views[v].margin(x[held][v])[:, None], y[held]) for v in VIEWS}
    z_held = np.column_stack([views[v].margin(x[held][v]) * lines[v][0] + lines[v][1] for v in VIEWS])
    model = Model(lex, views, lines, _line(z_held, y[held]), reject_below=0.5,
                  toxic=None, toxic_line=np.array([1.0, 0.0]), toxic_above=0.5)
    bad = {p: got["bad"].to_numpy(dtype=float)[at] for p, at in parts.items()}
    if len(set(bad["train"])) == 2 and len(set(bad[held])) == 2:
        model.toxic = Logistic(len(lex["toxic"])).fit(x["train"]["toxic"], bad["train"])
        margin = model.toxic.margin(x[held]["toxic"])
        model.toxic_line = _line(margin[:, None], bad[held])
        p = _sigmoid(margin * model.toxic_line[0] + model.toxic_line[1])
        if held == "held":
            model.toxic_above = 1 - cutoff(1 - p[y[held] == 1], good_loss / 2)
    if held == "held":
        model.reject_below = cutoff(model.score(x[held])["score"][y[held] == 1], good_loss / 2)
    return model


def classify(docs: DataFrame, labels: DataFrame, good=None, reject_below: float | None = None,
             toxic=None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             lang_col: str = "lang", chars_col: str = "n_chars", **options) -> DataFrame:
    """``docs`` plus p_content, p_layout, score (the chance to be good), p_toxic
    (six places each) and rejected: score under one cutoff or p_toxic over another.

    ``good`` is the label expression (default: quality is 1 and toxic is not),
    ``toxic`` that of p_toxic (default: toxic is 1; none beside a ``good`` of the
    caller's). Either cutoff is the strictest by which a good document is lost
    with a chance of at most half of ``good_loss`` (0.01), as measured on the
    labelled documents that calibrate; with too few good ones there (under 199
    at 0.01) it is 0.5. ``reject_below`` sets the score's cutoff instead.
    A document with several labels is good if all say so; null labels are no
    labels. A null text is empty, a null source, language or size a value of
    its own. Repeated rows get equal scores. If the labels do not hold both
    kinds, nothing is rejected and all scores are 1. Columns named like the
    results are replaced. An empty table gives an empty result.
    """
    if good is None:
        good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
        toxic = F.col("toxic") == 1 if toxic is None else toxic
    toxic = F.lit(False) if toxic is None else toxic
    names = ("p_content", "p_layout", "score", "p_toxic")
    docs = docs.drop(*names, "rejected")
    model = fit_model(docs, labels, good, toxic, id_col, text_col, source_col, lang_col, chars_col, **options)
    if model is None:
        return docs.withColumns({**{c: F.lit(float(c != "p_toxic")) for c in names}, "rejected": F.lit(False)})
    known = docs.sparkSession.sparkContext.broadcast(model)
    row, back = beside_text(docs, text_col)
    packed = docs.select(row.alias("row"), *_features(docs, text_col, source_col, lang_col, chars_col))

    def run(batch):
        m, tokens = known.value, _tokens(batch)
        p = m.score({v: [m.numbers(v, t) for t in tokens[v]] for v in VIEWS})
        yield {"row": batch["row"], "_text": batch["_text"], "p_content": p["content"].round(6),
               "p_layout": p["layout"].round(6), "score": p["score"].round(6),
               "p_toxic": m.toxicity(tokens["content"]).round(6)}

    row_type = packed.schema["row"].dataType.simpleString()
    out = map_rows(packed, run, f"row {row_type}, _text string, " + ", ".join(f"{c} double" for c in names))
    below = model.reject_below if reject_below is None else reject_below
    return out.select(*back, *names).withColumn(
        "rejected", (F.col("score") < below) | (F.col("p_toxic") > round(model.toxic_above, 6)))


@query("op9_quality_model")
def op9(spark: SparkSession, d: str) -> DataFrame:
    out = classify(load_table(spark, d, "documents"), load_table(spark, d, "labels"))
    return out.select("doc_id", "p_content", "p_layout", "score", (~F.col("rejected")).alias("kept"))
