"""Operator 6: SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. Two
fingerprints that differ in three bits at most differ in at most one bit in at
least two of the segments. Two segments that differ in one bit or none share a
codeword within four bits, the nearest one of either. So one side asks with the
nearest codewords of each pair of segments (3 keys), the other side answers for
all near ones (1 or 6 per segment): a join on those keys meets every pair to be
linked, and the bit distance is checked in the join.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascara.llm.common import hidden, load_table, map_rows, materialize, query
from cascara.llm.components import components
from cascara.llm.golay import near

SEGMENTS = ((0, 23), (23, 23), (46, 18))
PAIRS = ((0, 1), (0, 2), (1, 2))
_SHIFTS = np.arange(64, dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """A-Z in lower case, words between ASCII white space, shingles joined by
    one blank with repeats; bit i is set if over half the hashes set it."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashed = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hashed(b" ".join(words), seed)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    counts, n = np.zeros(64, dtype=np.int64), len(words) - shingle + 1
    for k in range(0, n, 100_000):  # memory stays bounded for very long texts
        stop = min(n, k + 100_000)
        h = np.fromiter((hashed(line[a:b], seed) for a, b in
                         zip(starts[k:stop].tolist(), ends[k + shingle - 1:stop + shingle - 1].tolist())),
                        dtype=np.uint64, count=stop - k)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(((2 * counts > n).astype(np.uint64) << _SHIFTS).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp): fp is the fingerprint as a signed 64-bit number,
    text_hash tells texts of one doc_id apart."""
    def run(batch):
        fps = np.array([fingerprint(t, shingle, seed) for t in batch["text"].to_pylist()],
                       dtype=np.uint64)
        yield {"doc_id": batch["doc_id"], "text_hash": batch["text_hash"], "fp": fps.view(np.int64)}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                                F.xxhash64(text_col).alias("text_hash")),
                    run, f"doc_id {kind}, text_hash long, fp long")


def _keys(fp: np.ndarray) -> list[np.ndarray]:
    """Near codewords of each segment, six columns each."""
    u = fp.view(np.uint64)
    return [near((u >> np.uint64(at) & np.uint64((1 << bits) - 1)).astype(np.int64))
            for at, bits in SEGMENTS]


def _probes(batch):
    fp = batch["fp"].to_numpy(zero_copy_only=False)
    c = [k[:, 0].astype(np.int64) for k in _keys(fp)]
    for p, (i, j) in enumerate(PAIRS):
        yield {"fp": fp, "key": p << 24 | c[i] << 12 | c[j]}


def _entries(batch):
    fp = batch["fp"].to_numpy(zero_copy_only=False)
    c = [k.astype(np.int64) for k in _keys(fp)]
    for p, (i, j) in enumerate(PAIRS):
        for x in range(6):
            for y in range(6):
                there = (c[i][:, x] >= 0) & (c[j][:, y] >= 0)
                if there.any():
                    yield {"fp": fp[there], "key": p << 24 | c[i][there, x] << 12 | c[j][there, y]}


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """(a, b), a < b: all pairs of different fingerprints within ``max_bits``
    (3 at most) of each other. ``fps`` holds distinct values in column fp."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the codes guarantee pairs of three differing bits at most")
    probes = map_rows(fps, _probes, "fp long, key int").withColumnRenamed("fp", "a")
    entries = map_rows(fps, _entries, "fp long, key int").withColumnRenamed("fp", "b")
    # Spark takes either side for as many rows as ``fps`` has, and would broadcast up
    # to 108 times what its limit allows.
    return (probes.join(entries.hint("merge"), (probes["key"] == entries["key"]) & (F.col("a") < F.col("b"))
                        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
            .select("a", "b").distinct())


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, seed: int = 42,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) for every row of ``docs``.

    component_id is the smallest doc_id that links lead to, the row's own
    included; root is the same for all rows of a component and no others.

    Equal fingerprints are one node, however many documents share it, so links
    are made between different fingerprints only. Null and empty texts have
    fingerprint zero and are linked like any other. A null doc_id takes part
    and is never the smallest unless its group has no other. Repeated rows stay.
    Other columns are ignored; an empty table gives an empty result.
    """
    rows = materialize(fingerprints(docs, shingle, seed, id_col, text_col), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    found = components(links(nodes.select("fp"), max_bits), "a", "b")
    rooted = (nodes.join(found, nodes["fp"] == found["node"], "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    rooted = materialize(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.select("fp", "root").join(least, "root")
    return rows.join(labels, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 3, seed: int = 42,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates: that of the
    smallest doc_id (nulls last; of several texts the one of least hash, of
    repeated rows one)."""
    groups, key = near_duplicates(docs, shingle, max_bits, seed, id_col, text_col), hidden("key")
    keep = (groups.groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull(), F.struct("doc_id", "text_hash").alias(key)))
                 .alias("least")).select(f"least.{key}"))
    keyed = docs.withColumn(key, F.struct(F.col(id_col).alias("doc_id"),
                                             F.xxhash64(text_col).alias("text_hash")))
    return keyed.join(keep, key, "left_semi").dropDuplicates([key]).drop(key)


@query("op6_simhash_groups")
def op6(spark: SparkSession, d: str) -> DataFrame:
    out = near_duplicates(load_table(spark, d, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      "component_id")
