"""Operator 13: how two tokenizers cut the same texts.

Documents are shuffled by their full text, so every distinct text is tokenised
and aligned once, with its number of documents as its weight. Byte offsets where
tokens of both tokenizers end cut a text into groups; an A token and a B token
are linked where their bytes overlap. How often each id pair is linked, over all
documents, comes from the distinct texts' link counts times their weights, and
each text is then measured against these counts.

1. Tasks align blocks of about ``BLOCK_BYTES`` of text. A block row holds its
   texts' measures, its distinct pairs with their weighted counts, and for each
   text its pairs (numbers in the block's list) with their counts there. It is
   written once, zstd-compressed: neither texts nor links are shuffled again.
2. The blocks' pairs are summed to one count per pair, and the highest of each B
   id is found.
3. The counts are dealt into shards of at most ``SHARD_BYTES``; each is broadcast
   in turn and the blocks are read past it. The pairs' number is bounded by the
   vocabularies, so are the shards; usually there is one.
4. Measures are summed over the shards and joined to the documents by the text's
   digest.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cascara.llm.common import (PART_BYTES, hidden, load_table, map_rows, materialize, query, scratch_path,
                                text_or_empty)
from cascara.llm.encode import default_tokenizer, encoder, in_slices

BLOCK_BYTES = 16 << 20
#: Of one broadcast: 17 bytes a pair.
SHARD_BYTES = 64 << 20
_B_BITS = 32
_MEASURES = ("n_a", "n_b", "n_groups", "n_links")
_BLOCK = ("content array<binary>, " + ", ".join(f"{c} array<long>" for c in _MEASURES)
          + ", groups_sha256 array<string>, n_pairs array<long>, at_low binary, at_high binary, "
          "n_low binary, n_high binary, pairs array<long>, counts array<long>")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class _Side:
    """A tokenizer and, for each of its ids, the bytes it stands for."""

    def __init__(self, path: str):
        self.coder = encoder(path, plain=True)
        self.bytes = self.coder.token_bytes()
        self.size = np.array(list(map(len, self.bytes)), dtype=np.int64)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(x, dtype="<u4").astype(np.int64) for x in self.coder.encode(texts)]

    def spells(self, ids: np.ndarray, raw: bytes) -> bool:
        return (int(self.size[ids].sum()) == len(raw)
                and b"".join(map(self.bytes.__getitem__, ids.tolist())) == raw)


@lru_cache(4)
def _sides(a: str, b: str) -> tuple[_Side, _Side]:
    """One pair per Python worker. A model puts the blank before a text itself."""
    return _Side(a), _Side(b)


@lru_cache(1)
def _signs(n: int) -> list[str]:
    """Each id followed by each of the three signs."""
    return [f"{i}{s}" for i in range(n) for s in ",|;"]


def links_of(a: np.ndarray, b: np.ndarray, ends: np.ndarray, n_bytes: int):
    """For A and B tokens by the offsets where they end, over texts that lie end
    to end (``ends``): (A number, B number) of each link, and for each text the
    number of links and of groups."""
    in_a, in_b = np.zeros(n_bytes + 1, dtype=bool), np.zeros(n_bytes + 1, dtype=bool)
    in_a[a], in_b[b] = True, True
    cells = np.flatnonzero(in_a | in_b)  # each cell between two ends is one link
    at = [(np.cumsum(x) - x)[cells] for x in (in_a, in_b)]
    both = np.flatnonzero(in_a & in_b)
    links, groups = (np.diff(np.searchsorted(x, ends, side="right"), prepend=0) for x in (cells, both))
    return *at, links, groups


def group_texts(a_ids, b_ids, a, b, n_a: np.ndarray, n_b: np.ndarray) -> list[str]:
    """``a1,a2|b1;a3|b2`` of each text: the groups' ids in order."""
    both = np.intersect1d(a, b, assume_unique=True)
    group_a, group_b = np.searchsorted(both, a), np.searchsorted(both, b)
    before_b = np.searchsorted(b, np.insert(both, 0, 0)[:-1], side="right")  # B tokens of earlier groups
    upto_a = np.searchsorted(a, both, side="right")  # A tokens of groups up to this one
    line = np.empty(len(a) + len(b), dtype=np.int64)
    line[np.arange(len(a)) + before_b[group_a]] = 3 * a_ids + (both[group_a] == a)
    line[np.arange(len(b)) + upto_a[group_b]] = 3 * b_ids + 2 * (both[group_b] == b)
    signs = _signs(int(line.max()) // 3 + 1 if len(line) < 2 else 1 << int(line.max() // 3).bit_length())
    words, marks = list(map(signs.__getitem__, line.tolist())), np.cumsum(np.insert(n_a + n_b, 0, 0)).tolist()
    return ["".join(words[x:y])[:-1] for x, y in zip(marks, marks[1:])]


class _Block:
    """Texts aligned so far, and the numbers of their pairs."""

    def __init__(self, sides: tuple[_Side, _Side]):
        self.sides, self.size = sides, 0
        self.number: dict[int, int] = {}
        self.counts = np.zeros(1 << 12, dtype=np.int64)
        self.cols: dict[str, list] = {c: [] for c in ("content", *_MEASURES, "groups_sha256", "n_pairs")}
        self.at: list[np.ndarray] = []
        self.n: list[np.ndarray] = []

    def add(self, contents: list[bytes], weights: list[int], texts: list[str]) -> None:
        self.size += sum(map(len, texts))
        raw = [b" " + t.encode() for t in texts]
        side_a, side_b = self.sides
        # A model adds the blank before a text; the byte-level side is given it.
        ids = [s.ids(texts if hasattr(s.coder, "sp") else [" " + t for t in texts]) for s in self.sides]
        good = [k for k, r in enumerate(raw) if all(s.spells(x[k], r) for s, x in zip(self.sides, ids))]
        n = {c: np.zeros(len(texts), dtype=np.int64) for c in (*_MEASURES, "n_pairs")}
        groups = [""] * len(texts)
        if good:
            a_ids, b_ids = (np.concatenate([x[k] for k in good]) for x in ids)
            n_a, n_b = (np.array([len(x[k]) for k in good]) for x in ids)
            ends = np.cumsum([len(raw[k]) for k in good])
            a, b = np.cumsum(side_a.size[a_ids]), np.cumsum(side_b.size[b_ids])
            at_a, at_b, n_links, n_groups = links_of(a, b, ends, int(ends[-1]))
            codes, distinct = pd.factorize(a_ids[at_a] << _B_BITS | b_ids[at_b])
            number = self.number
            mine = np.array([number.setdefault(c, len(number)) for c in distinct.tolist()], dtype=np.int64)
            while len(self.counts) < len(number):
                self.counts = np.concatenate((self.counts, np.zeros_like(self.counts)))
            # Sums below 2^53 are exact.
            times = np.repeat(np.array([weights[k] for k in good], dtype=np.float64), n_links)
            self.counts[mine] += np.bincount(codes, weights=times).astype(np.int64)
            # Distinct pairs of each text, in ascending order of their numbers.
            text_no = np.repeat(np.arange(len(good)), n_links)
            key, times = np.unique(text_no << 40 | mine[codes], return_counts=True)
            n_pairs = np.bincount(key >> 40, minlength=len(good))
            place = key & ((1 << 40) - 1)
            step = np.diff(place, prepend=0)
            step[np.cumsum(n_pairs)[:-1]] = place[np.cumsum(n_pairs)[:-1]]
            self.at.append(step)
            self.n.append(times)
            for c, x in zip(n, (n_a, n_b, n_groups, n_links, n_pairs)):
                n[c][good] = x
            for k, t in zip(good, group_texts(a_ids, b_ids, a, b, n_a, n_b)):
                groups[k] = hashlib.sha256(t.encode()).hexdigest()
        for c, x in (("content", contents), *((c, x.tolist()) for c, x in n.items()), ("groups_sha256", groups)):
            self.cols[c] += x

    def row(self) -> dict:
        at, n = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (self.at, self.n))
        low_high = {f"{c}_{p}": (x >> s & 0xFFFF).astype("<u2").tobytes()
                    for c, x in (("at", at), ("n", n)) for p, s in (("low", 0), ("high", 16))}
        return {**self.cols, **low_high, "pairs": list(self.number), "counts": self.counts[:len(self.number)].tolist()}


def _aligner(a: str, b: str, block_bytes: int):
    """Batches of (content, weight, text) to block rows."""
    schema = to_arrow_schema(T._parse_datatype_string(_BLOCK))

    def run(batches):
        block = _Block(_sides(a, b))
        for batch in batches:
            step = max(1, batch.num_rows * PART_BYTES // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                cols = [batch.slice(at, step)[c].to_pylist() for c in ("content", "weight", "text")]
                for x, y in in_slices(cols[2]):
                    block.add(*(c[x:y] for c in cols))
                    if block.size >= block_bytes:
                        yield pa.RecordBatch.from_pylist([block.row()], schema=schema)
                        block = _Block(_sides(a, b))
        if block.size:
            yield pa.RecordBatch.from_pylist([block.row()], schema=schema)

    return run


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best): all documents' links of each id pair, and whether no pair
    of the same B id has more."""
    pairs = (blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x"))
             .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.counts").alias("n"))
             .withColumn("b", F.col("pair").bitwiseAND((1 << _B_BITS) - 1)))
    pairs = materialize(pairs, "pair-counts")
    top = pairs.groupBy("b").agg(F.max("n").alias("top"))
    return pairs.join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _measured(blocks: DataFrame, known) -> DataFrame:
    """(content, measures, n_best, count_sum) of each text, by the pairs of one
    shard of counts."""
    def run(batch):
        pair, n, best = known.value
        for i in range(batch.num_rows):
            row = {c: batch[c][i] for c in batch.schema.names}
            codes = row["pairs"].values.to_numpy()
            at = np.minimum(np.searchsorted(pair, codes), max(len(pair) - 1, 0))
            there = pair[at] == codes if len(pair) else np.zeros(len(codes), dtype=bool)
            count, is_best = np.where(there, n[at], 0) if len(pair) else 0 * codes, there.copy()
            is_best[there] = best[at[there]]
            step, times = (np.frombuffer(row[f"{c}_low"].as_py(), "<u2").astype(np.int64)
                           | np.frombuffer(row[f"{c}_high"].as_py(), "<u2").astype(np.int64) << 16 for c in ("at", "n"))
            n_pairs = row["n_pairs"].values.to_numpy()
            ends = np.cumsum(n_pairs)
            place = np.cumsum(step)
            place -= np.repeat(np.insert(place, 0, 0)[np.insert(ends, 0, 0)[:-1]], n_pairs)
            sums = [np.diff(np.insert(np.cumsum(x), 0, 0)[ends], prepend=0)
                    for x in (times * is_best[place], times * count[place])]
            yield {"content": row["content"].values, **{c: row[c].values for c in (*_MEASURES, "groups_sha256")},
                   "n_best": sums[0], "count_sum": sums[1]}

    return map_rows(blocks.select("content", *_MEASURES, "groups_sha256", "n_pairs", "at_low", "at_high", "n_low",
                                  "n_high", "pairs"), run,
                    "content binary, " + ", ".join(f"{c} long" for c in _MEASURES)
                    + ", groups_sha256 string, n_best long, count_sum long")


def align(docs: DataFrame, a: str | None = None, b: str | None = None, text_col: str = "text",
          block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` plus n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256 of every whole text. ``a`` is a byte-level ``tokenizers`` file
    (texts get a blank before them), ``b`` a sentencepiece model that adds one.

    A null or empty text, and one that either tokenizer's tokens do not spell,
    has no tokens: zeros and an empty groups_sha256. Repeated rows and equal
    texts under other ids all count, and get equal measures. Ties for a B id's
    highest count are all best. Columns named like the results are replaced;
    others are kept. An empty table gives an empty result. A single text must fit
    in a task's memory with its tokens.
    """
    a, b = a or default_tokenizer(), b or default_model()
    results = (*_MEASURES, "n_best", "count_sum", "groups_sha256")
    docs = docs.drop(*results)
    spark, text, content = docs.sparkSession, text_or_empty(text_col), hidden("content")
    distinct = (docs.select(text.alias("text")).where("text <> ''")
                .groupBy("text").agg(F.count(F.lit(1)).alias("weight"))
                .select(F.unhex(F.sha2("text", 256)).alias("content"), "weight", "text"))
    path = scratch_path(spark, "aligned")
    (distinct.mapInArrow(_aligner(a, b, block_bytes), _BLOCK)
     .write.option("compression", "zstd").parquet(path))
    blocks = spark.read.schema(_BLOCK).parquet(path)
    counts = materialize(pair_counts(blocks), "pairs")
    shards = -(-17 * counts.count() // shard_bytes) or 1
    parts = None
    for k in range(shards):
        got = counts.where(F.pmod(F.xxhash64("pair"), F.lit(shards)) == k).toPandas().sort_values("pair")
        known = spark.sparkContext.broadcast((got["pair"].to_numpy(np.int64), got["n"].to_numpy(np.int64),
                                              got["best"].to_numpy(bool)))
        part = materialize(_measured(blocks, known), "measures")
        known.destroy()
        parts = part if parts is None else parts.unionAll(part)
    found = parts.groupBy(F.col("content").alias(content)).agg(
        *[F.first(c).alias(c) for c in (*_MEASURES, "groups_sha256")],
        *[F.sum(c).alias(c) for c in ("n_best", "count_sum")])
    joined = (docs.withColumn(content, F.when(text != "", F.unhex(F.sha2(text, 256))))
              .join(found, content, "left"))
    return joined.select(*docs.columns, *[
        F.coalesce(c, F.lit("") if c == "groups_sha256" else F.lit(0).cast("long")).alias(c) for c in results])


@query("op13_token_alignment")
def op13(spark: SparkSession, d: str) -> DataFrame:
    docs = load_table(spark, d, "documents").select("doc_id", "text")
    return align(docs).select("doc_id", *_MEASURES, "n_best", "count_sum", "groups_sha256")
