"""Operator 2: repeated passages removed by suffix automata of reference shards.

Every window of ``window`` consecutive words has one anchor: its ``gram``-word
piece of least hash, the leftmost of equal ones. What a window's words are
decides its anchor, so all occurrences of a window meet under one anchor, and
the windows of one anchor in a text are consecutive: a segment.

1. All segments: (anchor, segment hash, document, place). Anchors found in one
   document only are done. Where a segment also occurs in a smaller document, all
   of it goes.
2. Of the other words of a window at least half lie on one side of its anchor.
   So the distinct segments of an anchor are dealt by (anchor, side, the words
   next to it there): two rows a segment, and all occurrences of a window still
   meet. Groups of one segment or one document need no search.
3. A group's segments stream, in order of their documents, past the suffix
   automaton of a reference shard: the matching statistics tell the windows that
   earlier documents have, the automaton's states the first of these. Words of
   windows not met before join the shard. A shard that is full takes no more;
   segments with windows still unmatched go to the next round, and the first of
   them begin the next shard. There is one rule for groups of every size.
4. A window is removed where its document comes after its first one.

Sending every shard to every document would cost documents times shards. A
segment is sent past the shards of its groups only; nothing is broadcast.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cascara.llm.automaton import SuffixAutomaton
from cascara.llm.common import beside_text, load_table, map_rows, materialize, query, text_or_empty

_LAST = (1 << 63) - 1
_Q = 0x9E3779B97F4A7C15
_P = pow(_Q, -1, 1 << 64)
_SEGMENT = "anchor long, segment long, size int, doc long, copy long, place long"
_RUNS = "array<struct<first:int,last:int,doc:long>>"
_TEXTS = "anchor long, segment long, size int, doc long, words binary, groups array<long>"
_ROUND = f"g long, anchor long, segment long, size int, doc long, words binary, runs {_RUNS}, done boolean"


class _Powers:
    """Powers of an odd number modulo 2^64, as far as needed so far."""

    def __init__(self, base: int):
        self.base, self.table = np.uint64(base), np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if n > len(self.table):
            steps = np.full(max(n, 2 * len(self.table)), self.base, dtype=np.uint64)
            steps[0] = 1
            self.table = np.cumprod(steps, dtype=np.uint64)
        return self.table[:n]


_UP, _DOWN = _Powers(_P), _Powers(_Q)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def _sums(h: np.ndarray) -> np.ndarray:
    out = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * _DOWN.upto(len(h)), dtype=np.uint64, out=out[1:])
    return out


def _piece_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the words start..end of a text, the same wherever they stand."""
    x = (sums[end] - sums[start]) * _UP.upto(len(sums))[start]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def segments(h: np.ndarray, window: int, gram: int):
    """(anchor, segment hash, place, size) arrays of one text's segments."""
    n = len(h)
    sums = _sums(h)
    at = np.arange(n - gram + 1)
    grams = _piece_hashes(sums, at, at + gram)
    views = np.lib.stride_tricks.sliding_window_view(grams, window - gram + 1)
    anchor = np.concatenate([views[i:i + 50_000].argmin(axis=1) + np.arange(i, min(i + 50_000, len(views)))
                             for i in range(0, len(views), 50_000)])
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    end = np.concatenate((first[1:], [len(anchor)])) + window - 1
    return (grams[anchor[first]].view(np.int64), _piece_hashes(sums, first, end).view(np.int64),
            first, end - first)


def _runs(first_docs: list[int | None]) -> list[dict]:
    """Runs of consecutive windows with the same first document, None left out."""
    out: list[dict] = []
    for i, doc in enumerate(first_docs):
        if doc is None:
            continue
        if out and out[-1]["doc"] == doc and out[-1]["last"] == i - 1:
            out[-1]["last"] = i
        else:
            out.append({"first": i, "last": i, "doc": doc})
    return out


class References(SuffixAutomaton):
    """The automaton of one shard. Its sequences come in order of their documents,
    so the document that makes a state is the first to have its strings."""

    def __init__(self, window: int):
        super().__init__()
        self.window, self.doc, self.words = window, _LAST, 0
        self.first = [_LAST]

    def _new(self, length, step, link):
        self.first.append(self.doc)
        return super()._new(length, step, link)

    def _split(self, p, c, q):
        clone = super()._split(p, c, q)
        self.first[clone] = self.first[q]
        return clone

    def known(self, words: list[int]) -> list[int | None]:
        """For each window of ``words`` its first document here, if it has one."""
        out: list[int | None] = []
        link, length, w = self.link, self.length, self.window
        for v, n in self.matching(words):
            if n < w:
                out.append(None)
            else:
                while length[link[v]] >= w:
                    v = link[v]
                out.append(self.first[v])
        return out[w - 1:]

    def learn(self, doc: int, words: list[int], missing: list[bool]) -> None:
        """Add the words of the windows that are ``missing``."""
        self.doc = doc
        for run in _runs([0 if m else None for m in missing]):
            part = words[run["first"]:run["last"] + self.window]
            self.add(part)
            self.words += len(part)


def _search(window: int, shard_words: int):
    """Rows sorted by group and document to the same rows: done, with the runs of
    windows that earlier documents have, or left for the next shard."""
    schema = to_arrow_schema(T._parse_datatype_string(_ROUND))

    def run(batches):
        group, shard = None, None
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in schema}
            for row in batch.to_pylist():
                if row["g"] != group:
                    group, shard = row["g"], References(window)
                words = np.frombuffer(row["words"], dtype="<u8").tolist()
                docs: list[int | None] = [None] * (row["size"] - window + 1)
                for r in row["runs"]:
                    docs[r["first"]:r["last"] + 1] = [r["doc"]] * (r["last"] - r["first"] + 1)
                docs = [a if a is not None else b for a, b in zip(docs, shard.known(words))]
                missing = [d is None for d in docs]
                done = not any(missing) or shard.words < shard_words
                if done and any(missing):
                    shard.learn(row["doc"], words, missing)
                row.update(runs=_runs(docs), done=done, words=None if done else row["words"])
                for c, x in row.items():
                    out[c].append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return run


def removal_runs(rows: DataFrame, distinct: DataFrame, window: int, gram: int, shard_words: int) -> DataFrame:
    """(anchor, segment, size, runs): runs of windows that documents before the
    segment's least one have. ``rows``: (_doc, _copy, _text). ``distinct``: the
    segments of shared anchors, with least and variants."""
    # The words of the segments, from the first text that has each.
    wanted = (distinct.where("variants > 1")
              .groupBy(F.col("least.doc").alias("_doc"), F.col("least.copy").alias("_copy"))
              .agg(F.collect_list(F.struct("anchor", "segment", "size", "least.place"))
                   .alias("wanted")))  # one text's segments
    near = (window - gram + 1) // 2

    def groups(words: np.ndarray, anchor: int) -> list[int]:
        sums = _sums(words)
        at = np.arange(window - gram + 1)
        p = int(_piece_hashes(sums, at, at + gram).argmin())
        sides = [(b"l", words[p - near:p], p >= near), (b"r", words[p + gram:p + gram + near], len(words) - p - gram >= near)]
        return [int(np.int64(np.uint64(xxhash.xxh64_intdigest(side + x.tobytes(), anchor & (1 << 64) - 1)).view(np.int64)))
                for side, x, there in sides if there]

    def cut(batch):
        out = []
        for doc, text, wanted in zip(*(batch[c].to_pylist() for c in ("_doc", "_text", "wanted"))):
            h = word_hashes(text.encode().split()).astype("<u8")
            for w in wanted:
                words = h[w["place"]:w["place"] + w["size"]]
                out.append({**w, "doc": doc, "words": words.tobytes(), "groups": groups(words, w["anchor"])})
        yield {c: [r[c] for r in out] for c in ("anchor", "segment", "size", "doc", "words", "groups")}

    texts = materialize(map_rows(rows.join(wanted, ["_doc", "_copy"]).dropDuplicates(["_doc", "_copy"]), cut, _TEXTS),
                        "segment-words")
    dealt = texts.withColumn("g", F.explode("groups")).drop("groups")
    busy = (dealt.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("lo"), F.max("doc").alias("hi"))
            .where("n > 1 AND lo < hi").select("g"))
    left = dealt.join(busy, "g").select("g", "anchor", "segment", "size", "doc", "words",
                                        F.array().cast(_RUNS).alias("runs"))
    found = None
    while True:
        names = [f.split()[0] for f in _ROUND.split(", ")][:7]
        one = materialize(left.select(*names).repartition("g").sortWithinPartitions("g", "doc", "segment")
                          .mapInArrow(_search(window, shard_words), _ROUND), "shard")
        done = one.where("done").select("anchor", "segment", "size", "runs")
        found = done if found is None else found.unionAll(done)
        left = one.where("NOT done")
        if left.isEmpty():
            break
    # Two groups a segment at most.
    return found.groupBy("anchor", "segment", "size").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def remove_repeats(docs: DataFrame, window: int = 50, gram: int = 12, id_col: str = "doc_id",
                   text_col: str = "text", shard_words: int = 100_000) -> DataFrame:
    """``docs`` plus n_words, n_removed, spans (structs start, end in words,
    merged) and kept (the words left, joined by one blank).

    Words lie between ASCII white space. A word is removed if a window that
    covers it also starts in a row with a smaller ``id_col`` (an integer);
    windows are judged on the input. A null id comes after all others; rows of
    equal id do not remove each other's words; repeated rows are judged alike.
    A null or short text loses nothing. Columns named like the results are
    replaced. An empty table gives an empty result.
    """
    docs = docs.drop("n_words", "n_removed", "spans", "kept")
    rank = F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST))
    text = text_or_empty(text_col)
    rows = docs.select(rank.alias("_doc"), F.xxhash64(text).alias("_copy"), text.alias("_text"))

    def cut(batch):
        parts = []
        for doc, copy, t in zip(*(batch[c].to_pylist() for c in ("_doc", "_copy", "_text"))):
            words = t.encode().split()
            if len(words) >= window:
                anchor, segment, place, size = segments(word_hashes(words), window, gram)
                n = len(anchor)
                parts.append((anchor, segment, size.astype(np.int32), np.full(n, doc),
                              np.full(n, copy), place))
        if parts:
            yield dict(zip(("anchor", "segment", "size", "doc", "copy", "place"),
                           map(np.concatenate, zip(*parts))))

    found = materialize(map_rows(rows, cut, _SEGMENT), "anchors")
    distinct = (found.groupBy("anchor", "segment", "size")
                .agg(F.min(F.struct("doc", "copy", "place")).alias("least"), F.max("doc").alias("last")))
    distinct = materialize(distinct, "segments")
    shared = (distinct.groupBy("anchor")
              .agg(F.min("least.doc").alias("lo"), F.max("last").alias("hi"),
                   F.count(F.lit(1)).alias("variants")).where("lo < hi").select("anchor", "variants"))
    distinct = materialize(distinct.join(shared, "anchor"), "shared-segments")
    runs = removal_runs(rows, distinct, window, gram, shard_words)
    told = (distinct.select("anchor", "segment", "size", F.col("least.doc").alias("least"))
            .join(runs, ["anchor", "segment", "size"], "left"))
    # Beyond its least document the whole segment goes, there what earlier ones have.
    spans = F.when(F.col("doc") > F.col("least"), F.array(F.struct(
        F.col("place").alias("start"), (F.col("place") + F.col("size")).alias("end")))).otherwise(
        F.transform(F.filter("runs", lambda r: r["doc"] < F.col("doc")), lambda r: F.struct(
            (F.col("place") + r["first"]).alias("start"), (F.col("place") + r["last"] + window).alias("end"))))
    hits = (found.join(told, ["anchor", "segment", "size"])
            .select(F.col("doc").alias("_doc"), F.col("copy").alias("_copy"), F.explode(spans).alias("span"))
            .groupBy("_doc", "_copy").agg(F.collect_set("span").alias("_spans")))  # one text's spans
    row, back = beside_text(docs, text_col)
    joined = (docs.select(row.alias("row"), rank.alias("_doc"), F.xxhash64(text).alias("_copy"),
                          F.col(text_col).alias("_text"))
              .join(hits, ["_doc", "_copy"], "left").select("row", "_text", "_spans"))

    def apply(batch):
        out: dict[str, list] = {c: [] for c in ("n_words", "n_removed", "spans", "kept")}
        for t, found in zip(batch["_text"].to_pylist(), batch["_spans"].to_pylist()):
            words = (t or "").encode().split()
            spans, kept, at = [], [], 0
            for s in sorted((s["start"], s["end"]) for s in found or ()):
                if spans and s[0] <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], max(s[1], spans[-1][1]))
                else:
                    spans.append(s)
            for a, b in spans:
                kept += words[at:a]
                at = b
            kept += words[at:]
            for name, value in zip(out, (len(words), len(words) - len(kept),
                                         [{"start": a, "end": b} for a, b in spans],
                                         b" ".join(kept).decode())):
                out[name].append(value)
        yield {"row": batch["row"], "_text": batch["_text"], **out}

    row_type = joined.schema["row"].dataType.simpleString()
    done = map_rows(joined, apply, f"row {row_type}, _text string, n_words long, n_removed long, "
                                   "spans array<struct<start:long,end:long>>, kept string")
    return done.select(*back, "n_words", "n_removed", "spans", "kept")


_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, i, sha256(array_to_string(list_slice(w, i, i + 49), ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
), f AS (
  SELECT h, min(doc_id) AS first_doc FROM s GROUP BY h
), c AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i
  FROM s JOIN f USING (h) WHERE first_doc < doc_id
), e AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d
), k AS (
  SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) FILTER (c.i IS NULL) AS kept,
         count(c.i) AS n_removed
  FROM e LEFT JOIN c ON e.doc_id = c.doc_id AND e.i = c.i GROUP BY e.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""


@query("op2_substring_dedup", _SQL)
def op2(spark: SparkSession, d: str) -> DataFrame:
    out = remove_repeats(load_table(spark, d, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
