"""Operator 10: benchmark decontamination.

One generalised suffix automaton of the normalised test items streams over the
words of every document. Wherever the longest match reaches the window length
(or a whole shorter item) those words are hit; merged, they are the spans to
remove, and a document hit beyond a share of its words is refused whole.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascara.llm.automaton import CompactAutomaton, SuffixAutomaton
from cascara.llm.common import beside_text, load_table, map_rows, materialize, query

#: Text of one automaton and what it may take as built, in bytes. More test items
#: make more automata, and the documents pass them one after the other.
SHARD_BYTES, AUTOMATON_BYTES = 2 << 20, 96 << 20

# Bytes that are not part of a word (ASCII but for digits and letters).
_NOT_WORD = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_NORMAL = bytes(ord(" ") if b in _NOT_WORD else b + 32 if 0x41 <= b <= 0x5A else b
                for b in range(256))
_RUN = re.compile(rb"[^ ]+")


def words_of(text: str | None) -> list[bytes]:
    """A-Z in lower case; runs of digits, letters and all beyond ASCII."""
    # split(b" ") would keep empty words; bytes beyond ASCII never split.
    return [w for w in (text or "").encode().translate(_NORMAL).split(b" ") if w]


class Items:
    """The automaton of some test items, with what a match at a state means."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.window, self.vocabulary = window, {}
        sam = SuffixAutomaton()
        rows = []
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if ids:
                sam.add(ids)
                rows.append((item_id, ids))
        self.shortest = min((min(window, len(ids)) for _, ids in rows), default=0)
        n = len(sam.link)
        # The state that holds a state's suffix of window length, if it has one.
        self.at_window = [-1] * n
        for v in sam.by_length():
            if sam.length[v] >= window:
                up = sam.link[v]
                self.at_window[v] = v if sam.length[up] < window else self.at_window[up]
        # The items of a window's state: mostly one, by its number.
        self.names = [item_id for item_id, _ in rows]
        self.one, self.many = array("i", [-1] * n), {}
        ends: dict[int, dict[int, set[str]]] = {}
        for number, (item_id, ids) in enumerate(rows):
            states = sam.states(ids)
            if len(ids) < window:
                ends.setdefault(states[-1], {}).setdefault(len(ids), set()).add(item_id)
            for v in states:
                at = self.at_window[v]
                if at >= 0 and self.one[at] not in (-1, number):
                    self.many.setdefault(at, {self.one[at]}).add(number)
                elif at >= 0:
                    self.one[at] = number
        # Whole short items among a state's suffixes: (length, items), own and
        # by the links.
        self.short: dict[int, list[tuple[int, set[str]]]] = {}
        for v in sam.by_length():
            found = self.short.get(sam.link[v], []) + list(ends.get(v, {}).items())
            if found:
                self.short[v] = found
        self.at_window = array("i", self.at_window)
        self.sam = CompactAutomaton(sam)

    @property
    def nbytes(self) -> int:
        """About what a process holds."""
        sets = sum(300 + 60 * len(x) for x in self.many.values()) + sum(300 * len(x) for x in self.short.values())
        return (self.sam.nbytes + 8 * len(self.one) + 150 * len(self.vocabulary)
                + sum(60 + len(x) for x in self.names) + sets)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans [start, end) of hit words, and the items that hit."""
        if not self.shortest or len(words) < self.shortest:
            return [], set()
        get = self.vocabulary.get
        ids = [get(w, 0) for w in words]
        # A word that no item has ends every match: only runs between such
        # words that are long enough need the automaton.
        gaps = np.flatnonzero(np.array(ids) == 0)
        starts = np.concatenate(([0], gaps + 1))
        ends = np.concatenate((gaps, [len(ids)]))
        long = ends - starts >= self.shortest
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for a, b in zip(starts[long].tolist(), ends[long].tolist()):
            for i, (v, n) in enumerate(self.sam.matching(ids[a:b]), a + 1):
                if n >= self.window:
                    spans.append((i - self.window, i))
                    at = self.at_window[v]
                    items.update(map(self.names.__getitem__, self.many.get(at) or (self.one[at],)))
                for size, ids_of in self.short.get(v, ()):
                    if n >= size:
                        spans.append((i - size, i))
                        items |= ids_of
        return merged(spans), items


def merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans; a span goes with all between
    its first and last word."""
    data = text.encode()
    places = [m.span() for m in _RUN.finditer(data.translate(_NORMAL))]
    kept, at = [], 0
    for a, b in spans:
        kept.append(data[at:places[a][0]])
        at = places[b - 1][1]
    return b"".join([*kept, data[at:]]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10,
                  max_share: float = 0.5, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` plus n_words, n_hit, items (sorted ids of items with a window
    in the text), spans (structs start, end in words), clean (the text without
    its spans) and refused (more than ``max_share`` of the words are hit).

    A null text has no words, and its clean text is null. Items without words
    (null, empty, punctuation) match nothing; repeated items count once; an
    item with a null id has the id "". Rows that repeat are all judged. Columns
    named like the results are replaced. Empty tables give an empty result, or
    documents without hits. ``refused`` compares counts, so a document without
    words is never refused.

    The items' size is summed first: each automaton holds at most about
    ``shard_bytes`` of them, however many there are, and is what is broadcast, as
    arrays. One that turns out larger than ``AUTOMATON_BYTES`` is not sent: its
    items are dealt anew into more shards.
    """
    items = (benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("id"),
                              F.col(item_text_col).alias("text"))
             .where("text IS NOT NULL").distinct())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # (remainder, modulus) classes of the items' hashes, one automaton each.
    n = -(-total // shard_bytes) or 1
    classes = [(k, n) for k in range(n)]
    docs = docs.drop("n_words", "n_hit", "items", "spans", "clean", "refused")

    def shard(k: int, n: int):
        """The class's automaton, or None where it was split."""
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).sort("id", "text")
        rows = [(r["id"], r["text"]) for r in part.collect()]
        built = Items(rows, window)
        if built.nbytes > AUTOMATON_BYTES and len(rows) > 1:
            classes.extend([(k, 2 * n), (k + n, 2 * n)])
            return None
        return docs.sparkSession.sparkContext.broadcast(built)

    row, back = beside_text(docs, text_col)
    packed = docs.select(row.alias("row"), F.col(text_col).alias("_text"))
    row_type = packed.schema["row"].dataType.simpleString()
    result = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>, clean string, refused boolean"

    def judged(texts, spans, items):
        cols: dict[str, list] = {f.split()[0]: [] for f in result.split(", ")}
        for t, s, i in zip(texts, spans, items):
            s, n = merged(s), len(words_of(t))
            hit = sum(b - a for a, b in s)
            for name, value in zip(cols, (n, hit, sorted(i), [{"start": a, "end": b} for a, b in s],
                                          t if not s else without(t, s), hit > max_share * n)):
                cols[name].append(value)
        return cols

    known = shard(*classes.pop())
    if known and not classes:
        def whole(batch):
            texts = batch["_text"].to_pylist()
            out = [known.value.scan(words_of(t)) for t in texts]
            yield {"row": batch["row"], "_text": batch["_text"],
                   **judged(texts, [s for s, _ in out], [i for _, i in out])}

        out = map_rows(packed, whole, f"row {row_type}, _text string, {result}")
    else:
        key = F.struct(F.xxhash64("_text").alias("a"), F.xxhash64(F.lit(1), "_text").alias("b"))
        hits = None
        while known or classes:
            known = known or shard(*classes.pop())
            if not known:
                continue

            def scan(batch, known=known):
                out = [known.value.scan(words_of(t)) for t in batch["_text"].to_pylist()]
                yield {"_text": batch["_text"],
                       "spans": [[{"start": a, "end": b} for a, b in spans] for spans, _ in out],
                       "items": [sorted(ids) for _, ids in out]}

            part = materialize(
                map_rows(packed.select("_text"), scan, "_text string, "
                         "spans array<struct<start:long,end:long>>, items array<string>")
                .where("size(spans) > 0").select(key.alias("_key"), "spans", "items").distinct(),
                "shard-hits")
            known.destroy()
            known = None
            hits = part if hits is None else hits.unionAll(part)
        hits = hits.groupBy("_key").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        joined = packed.withColumn("_key", key).join(hits, "_key", "left").drop("_key")

        def finish(batch):
            spans = [[(x["start"], x["end"]) for x in s or []] for s in batch["spans"].to_pylist()]
            yield {"row": batch["row"], "_text": batch["_text"],
                   **judged(batch["_text"].to_pylist(), spans, [i or [] for i in batch["items"].to_pylist()])}

        out = map_rows(joined, finish, f"row {row_type}, _text string, {result}")
    return out.select(*back, *[f.split()[0] for f in result.split(", ")])


_SQL = r"""
WITH t AS (
  SELECT 'd' AS kind, doc_id, NULL AS id, text FROM documents
  UNION ALL SELECT DISTINCT 'i', NULL, coalesce(item_id::VARCHAR, ''), text FROM benchmark WHERE text IS NOT NULL
), n AS (
  SELECT kind, doc_id, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM t
), i AS (
  SELECT id, w, least(len(w), 10) AS size FROM n WHERE kind = 'i' AND len(w) > 0
), iw AS (
  SELECT DISTINCT id, size, array_to_string(w[k:k + size - 1], ' ') AS x
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS k FROM i)
), dw AS (
  SELECT doc_id, size, k, array_to_string(w[k:k + size - 1], ' ') AS x
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k
        FROM n, (SELECT DISTINCT size FROM i) WHERE kind = 'd' AND len(w) >= size)
), h AS (
  SELECT doc_id, k, size, id FROM dw JOIN iw USING (size, x)
), s AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM (SELECT DISTINCT doc_id, k, size FROM h)) GROUP BY doc_id
), g AS (
  SELECT doc_id, count(DISTINCT id) AS n_items, string_agg(DISTINCT id, ',' ORDER BY id) AS ids FROM h GROUP BY doc_id
)
SELECT n.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM n LEFT JOIN s ON n.doc_id = s.doc_id LEFT JOIN g ON n.doc_id = g.doc_id WHERE kind = 'd'
"""


@query("op10_decontaminate", _SQL)
def op10(spark: SparkSession, d: str) -> DataFrame:
    docs = load_table(spark, d, "documents").select("doc_id", "text")
    out = decontaminate(docs, load_table(spark, d, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))
