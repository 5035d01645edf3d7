"""Operator 12: a trie of conversation prefixes from sorted turn-id matrices.

Every conversation is first rebuilt: it opens with the head of its group's first
conversation. A node is a distinct sequence of first turns; conversations that
start with it are its members. Nodes, children, leaves and the words that sharing
prefixes saves are aggregated for every depth.

1. Turns become 128-bit digests with word counts; texts go no further.
2. Rebuilt conversations are range-partitioned by their digests, then their id,
   so equal ones may lie in several shards and none is hot.
3. A shard numbers its turns, pads them to matrices (a block of columns at a
   time, of the conversations that reach it) and lexsorts the rows. The columns'
   change masks, OR-accumulated with those of earlier depths, mark where nodes
   start, and ``reduceat`` aggregates every depth; a pass from the deepest level
   up gives children, leaves and savings.
4. Only nodes that hold a shard's first or last row can go on in another shard.
   For these a shard gives partial figures without their boundary children: at
   most two nodes a depth and shard. They recombine by their path's digest, tree
   sums are taken per first turn, and the root adds up the first turns.
5. The ids that end at a node are hashed in order. Inside a shard that is local;
   for boundary nodes the shards hand on pieces of the joined ids, which stream
   through the hash in order.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cascara.llm.common import WORD, load_table, materialize, query

_COLUMNS = 8  # of one padded matrix
_PIECE = 1000  # ids handed on in one row
_EMPTY = hashlib.sha256(b"").hexdigest()
_ROW = ("kind int, key binary, parent binary, top binary, conv_id long, depth long, parent_conv_id long, "
        "n_convs long, n_children long, n_leaves long, saved_tokens long, words long, ends string")
_NODE, _PART, _ENDS = range(3)
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt(turns: DataFrame, group: int = 20, heads: int = 4, conv: str = "conv_id",
            turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): the digests and word counts of each conversation's turns
    after its first h became those of conversation c - c % ``group``, where h is
    the CRC-32 of c's decimal digits modulo ``heads``."""
    said, who = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text, role))
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).alias("turn"),
        F.unhex(F.md5(F.concat(F.length(who), F.lit(":"), who, said))).alias("id"),
        F.regexp_count(said, F.lit(WORD)).alias("words"))
    own = materialize(
        rows.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("turn", "id", "words"))).alias("t"))
        .select("c", F.transform("t", lambda x: F.struct(x["id"].alias("id"), x["words"].alias("words"))).alias("t")),
        "conversations")
    first = own.where(F.col("c") % group == 0).select(F.col("c").alias("g"), F.slice("t", 1, heads).alias("head"))
    h = (F.crc32(F.col("c").cast("string")) % heads).cast("int")
    head = F.slice(F.coalesce("head", F.slice("t", 1, 0)), F.lit(1), h)
    rest = F.slice("t", h + 1, F.greatest(F.size("t") - h, F.lit(0)))
    return (own.withColumn("g", F.col("c") - F.col("c") % group).join(first, "g", "left")
            .select(F.col("c").alias("conv_id"), F.concat(head, rest).alias("turns")))


class _Shard:
    """The sorted conversations of one range."""

    def __init__(self, conv: np.ndarray, size: np.ndarray, digests: bytes, words: np.ndarray):
        d = np.frombuffer(digests, dtype=">u8").astype(np.uint64).reshape(-1, 2)
        by = np.lexsort((d[:, 1], d[:, 0]))
        new = np.ones(len(d), dtype=bool)
        new[1:] = (d[by[1:]] != d[by[:-1]]).any(axis=1)
        self.ids = np.empty(len(d), dtype=np.int64)
        self.ids[by] = np.cumsum(new)  # from 1, in the digests' order; 0 pads
        self.digests, self.words = digests, words
        start = np.cumsum(size) - size
        order = np.lexsort((conv, self._ranks(start, size)))
        self.conv, self.size, self.start = conv[order], size[order], start[order]

    def _column(self, start: np.ndarray, size: np.ndarray, depth: int) -> np.ndarray:
        """The turn ids at a depth from 0, padded."""
        out = np.zeros(len(start), dtype=np.int64)
        there = size > depth
        out[there] = self.ids[start[there] + depth]
        return out

    def _ranks(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """For each row the place of the first row with the same turns."""
        rank, rows, depth = np.zeros(len(size), dtype=np.int64), np.arange(len(size)), 0
        while len(rows):
            matrix = [self._column(start[rows], size[rows], depth + k) for k in range(_COLUMNS)]
            by = np.lexsort((*matrix[::-1], rank[rows]))
            rows, old = rows[by], rank[rows[by]]
            group = np.concatenate(([True], old[1:] != old[:-1]))
            place = old + np.arange(len(rows)) - np.maximum.accumulate(np.where(group, np.arange(len(rows)), 0))
            new = group.copy()
            for column in matrix:
                new[1:] |= column[by[1:]] != column[by[:-1]]
            rank[rows] = np.maximum.accumulate(np.where(new, place, 0))
            depth += _COLUMNS
            rows = rows[size[rows] >= depth]  # those that end here go before longer ones
        return rank

    def nodes(self):
        """Arrays of all nodes, level after level: depth, parent's number, rows
        first..last, members, least member, words of the last turn, rows that end
        there, and whether the node holds the shard's first or last row."""
        n = len(self.conv)
        rows, above, depth, total = np.arange(n), np.zeros(n, dtype=np.int64), 0, 0
        levels = []
        while len(rows):
            change = np.ones(len(rows), dtype=bool)
            column = self._column(self.start[rows], self.size[rows], depth - 1) if depth else above
            change[1:] = (above[1:] != above[:-1]) | (column[1:] != column[:-1])
            starts = np.flatnonzero(change)
            first, last = rows[starts], rows[np.append(starts[1:], len(rows)) - 1]
            at = self.start[first] + depth - 1
            levels.append({
                "depth": np.full(len(starts), depth), "parent": above[starts] if depth else above[starts] - 1,
                "first": first, "last": last, "n_convs": np.add.reduceat(np.ones(len(rows), dtype=np.int64), starts),
                "conv_id": np.minimum.reduceat(self.conv[rows], starts),
                "words": self.words[at] if depth else np.zeros(1, dtype=np.int64),
                "ends": np.add.reduceat((self.size[rows] == depth).astype(np.int64), starts),
                "boundary": (first == 0) | (last == n - 1)})
            number, total = total + np.cumsum(change) - 1, total + len(starts)
            on = self.size[rows] > depth
            rows, above, depth = rows[on], number[on], depth + 1
        return {c: np.concatenate([x[c] for x in levels]) for c in levels[0]}, [len(x["depth"]) for x in levels]

    def key(self, row: int, depth: int) -> list[bytes]:
        """Digests of the row's first 0 to ``depth`` turns."""
        h = hashlib.md5()
        keys, at = [h.digest()], 16 * int(self.start[row])
        for k in range(depth):
            h.update(self.digests[at + 16 * k:at + 16 * k + 16])
            keys.append(h.copy().digest())
        return keys

    def ended(self, first: int, count: int, piece: int):
        for a in range(first, first + count, piece):
            yield int(self.conv[a]), ",".join(map(str, self.conv[a:min(a + piece, first + count)].tolist()))

    def rows(self):
        """Column dicts of ``_ROW``."""
        t, levels = self.nodes()
        inner = ~t["boundary"]
        parent, total = t["parent"], len(inner)
        children = np.bincount(parent[inner], minlength=total)
        leaves = (children == 0).astype(np.int64) * inner
        saved = (t["n_convs"] - 1) * t["words"] * inner
        edge = np.cumsum([0, *levels])
        for a, b in zip(edge[-2:0:-1].tolist(), edge[:0:-1].tolist()):
            up = np.arange(a, b)[inner[a:b]]
            np.add.at(leaves, parent[up], leaves[up])
            np.add.at(saved, parent[up], saved[up])
        keys: dict[int, tuple[bytes, bytes | None, bytes | None]] = {}
        at_edge = np.flatnonzero(~inner)
        for row in (0, len(self.conv) - 1):
            path = self.key(row, int(self.size[row]))
            for i in at_edge[(t["first"][at_edge] <= row) & (row <= t["last"][at_edge])].tolist():
                d = int(t["depth"][i])
                keys[i] = path[d], path[d - 1] if d else None, path[1] if d else None
        ends = np.full(total, _EMPTY, dtype=object)
        for i in np.flatnonzero(inner & (t["ends"] > 0)).tolist():
            h = hashlib.sha256()
            for k, (_, ids) in enumerate(self.ended(int(t["first"][i]), int(t["ends"][i]), _PIECE)):
                h.update((("," if k else "") + ids).encode())
            ends[i] = h.hexdigest()
        known = inner & (parent >= 0) & inner[np.maximum(parent, 0)]
        yield {
            "kind": np.where(inner, _NODE, _PART), "key": [keys[i][0] if i in keys else None for i in range(total)],
            "parent": [keys[i][1] if i in keys else None if known[i] else keys[int(parent[i])][0] for i in range(total)],
            "top": [keys[i][2] if i in keys else None for i in range(total)],
            "conv_id": t["conv_id"], "depth": t["depth"],
            "parent_conv_id": pa.array(t["conv_id"][np.maximum(parent, 0)], mask=~known),
            "n_convs": t["n_convs"], "n_children": children, "n_leaves": leaves, "saved_tokens": saved,
            "words": t["words"], "ends": list(ends)}
        pieces = [(keys[i][0], c, ids) for i in at_edge.tolist()
                  for c, ids in self.ended(int(t["first"][i]), int(t["ends"][i]), _PIECE)]
        none = [None] * len(pieces)
        yield {**{f.split()[0]: none for f in _ROW.split(", ")}, "kind": [_ENDS] * len(pieces),
               "key": [p[0] for p in pieces], "conv_id": [p[1] for p in pieces], "ends": [p[2] for p in pieces]}


def _shards(schema: pa.Schema):
    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            turns = batch["turns"]
            size = np.diff(turns.offsets.to_numpy())
            flat = turns.flatten()
            held.append((batch["conv_id"].to_numpy(), size, b"".join(flat.field("id").to_pylist()),
                         flat.field("words").to_numpy(zero_copy_only=False)))
        if held and sum(len(x[0]) for x in held):
            conv, size, digests, words = zip(*held)
            shard = _Shard(np.concatenate(conv), np.concatenate(size).astype(np.int64), b"".join(digests),
                           np.concatenate(words).astype(np.int64))
            for cols in shard.rows():
                n = len(cols["kind"])
                for a in range(0, n, 10_000):
                    part = {c: x[a:a + 10_000] for c, x in cols.items()}
                    yield pa.RecordBatch.from_arrays(
                        [x if isinstance(x := part[f.name], pa.Array) else pa.array(x, f.type) for f in schema],
                        schema=schema)

    return run


def _hash_in_order(batches):
    """Pieces sorted by key and first id to (key, ends_sha256)."""
    last, h = None, None
    for batch in batches:
        done = []
        for key, ids in zip(batch["key"].to_pylist(), batch["ends"].to_pylist()):
            if key != last:
                if last is not None:
                    done.append((last, h.hexdigest()))
                last, h = key, hashlib.sha256()
                h.update(ids.encode())
            else:
                h.update(b"," + ids.encode())
        yield pa.RecordBatch.from_pydict({"key": pa.array([k for k, _ in done], pa.binary()),
                                          "ends_sha256": pa.array([x for _, x in done], pa.string())})
    if last is not None:
        yield pa.RecordBatch.from_pydict({"key": pa.array([last], pa.binary()),
                                          "ends_sha256": pa.array([h.hexdigest()], pa.string())})


def _tree_sums(t: pd.DataFrame) -> pd.DataFrame:
    """One first turn's recombined boundary nodes: sums over their subtrees."""
    t = t.sort_values("depth", kind="stable").reset_index(drop=True)
    place = {bytes(k): i for i, k in enumerate(t["key"])}
    parent = [place.get(bytes(p), -1) for p in t["parent"]]
    children, leaves = t["n_children"].to_numpy().copy(), t["n_leaves"].to_numpy().copy()
    saved = t["saved_tokens"].to_numpy() + (t["n_convs"].to_numpy() - 1) * t["words"].to_numpy()
    conv = t["conv_id"].to_numpy()
    above = [int(conv[p]) if p >= 0 else None for p in parent]
    for p in parent:
        if p >= 0:
            children[p] += 1
    for i in range(len(t) - 1, -1, -1):  # the deepest first
        leaves[i] += children[i] == 0
        if parent[i] >= 0:
            leaves[parent[i]] += leaves[i]
            saved[parent[i]] += saved[i]
    return t.assign(n_children=children, n_leaves=leaves, saved_tokens=saved,
                    parent_conv_id=pd.array(above, dtype="Int64"))[
        ["key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]]


def trie(conversations: DataFrame, shard_turns: int = 2_000_000) -> DataFrame:
    """One row per node of the trie of ``conversations`` (conv_id, turns: the
    result of :func:`rebuilt`): ``RESULT``.

    conv_id is the node's smallest member, parent_conv_id its parent's (root:
    null); n_leaves counts childless nodes of the subtree, saved_tokens sums
    (members - 1) times the words of the last turn over it; ends_sha256 is the
    SHA-256 of the decimal ids of the members that end at the node, ascending,
    joined by commas. Conversations without turns end at the root. Without
    conversations there are no nodes, not even a root.

    A conversation's digests (24 bytes a turn) must fit in a row. Shards hold
    about ``shard_turns`` turns, and there are at least as many as
    ``spark.sql.shuffle.partitions``.
    """
    spark = conversations.sparkSession
    conversations = materialize(conversations, "rebuilt")
    total = conversations.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_turns))
    struct = T._parse_datatype_string(_ROW)
    ids = F.transform("turns", lambda x: x["id"])
    found = materialize(
        conversations.repartitionByRange(n, ids, "conv_id").mapInArrow(_shards(to_arrow_schema(struct)), struct), "trie")

    def least(c: str) -> Column:
        return F.min(c).alias(c)

    parts = materialize(
        found.where(F.col("kind") == _PART).groupBy("key", "parent", "top", "depth")
        .agg(least("conv_id"), least("words"),
             *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]), "boundary")
    numbers = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    # A first turn's boundary nodes: two a depth and shard at most.
    below = materialize(
        parts.where("depth > 0").groupBy("top").applyInPandas(
            _tree_sums, "key binary, " + ", ".join(f"{c} long" for c in numbers)), "boundary-sums")
    root = parts.where("depth = 0").first()
    if root is None:
        return (found.where("false").select(*numbers, F.col("ends").alias("ends_sha256")))
    tops = below.where("depth = 1").agg(F.count(F.lit(1)), F.sum("n_leaves"), F.sum("saved_tokens")).first()
    children = root["n_children"] + tops[0]
    top = spark.range(1).select(
        F.lit(bytearray(root["key"])).alias("key"), F.lit(root["conv_id"]).alias("conv_id"),
        F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(root["n_convs"]).alias("n_convs"), F.lit(children).cast("long").alias("n_children"),
        F.lit(root["n_leaves"] + (tops[1] or 0) + (children == 0)).cast("long").alias("n_leaves"),
        F.lit(root["saved_tokens"] + (tops[2] or 0)).cast("long").alias("saved_tokens"))
    ends = (found.where(F.col("kind") == _ENDS).select("key", "conv_id", "ends")
            .repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ends")
            .mapInArrow(_hash_in_order, "key binary, ends_sha256 string"))
    at_root = F.when(F.col("depth") == 1, F.lit(root["conv_id"]))
    boundary = (below.withColumn("parent_conv_id", F.coalesce("parent_conv_id", at_root))
                .unionByName(top).join(ends, "key", "left")
                .select(*numbers, F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256")))
    inner = found.where(F.col("kind") == _NODE).withColumn("parent_conv_id", F.coalesce("parent_conv_id", at_root))
    names = [*numbers, F.col("ends").alias("ends_sha256")]
    left = inner.where("parent_conv_id IS NULL").drop("parent_conv_id").join(
        parts.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent")
    return inner.where("parent_conv_id IS NOT NULL").select(*names).unionAll(left.select(*names)).unionAll(boundary)


_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS g,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id AS c, list(g ORDER BY turn NULLS FIRST, g, w) AS gs, list(w ORDER BY turn NULLS FIRST, g, w) AS ws,
         list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
           lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda y, i: xor(y >> 1, 3988292384 * (y & 1)))) AS crc
  FROM t GROUP BY conv_id
), r AS (
  SELECT o.c, list_concat(coalesce(f.gs, [])[1:h], o.gs[h + 1:]) AS gs, list_concat(coalesce(f.ws, [])[1:h], o.ws[h + 1:]) AS ws
  FROM (SELECT *, xor(crc, 4294967295) % 4 AS h FROM own) o LEFT JOIN own f ON f.c = o.c - o.c % 20
), p AS (
  SELECT c, d, len(gs) AS size, md5(array_to_string(gs[1:d], ',')) AS k,
         CASE WHEN d > 0 THEN md5(array_to_string(gs[1:d - 1], ',')) END AS pk, CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w
  FROM (SELECT *, unnest(range(0, len(gs) + 1)) AS d FROM r)
), n AS (
  SELECT d, k, any_value(pk) AS pk, any_value(w) AS w, min(c) AS conv, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (size = d), '')) AS ends
  FROM p GROUP BY d, k
), ch AS (
  SELECT d - 1 AS d, pk AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY d, pk
), m AS (
  SELECT n.*, coalesce(ch.n_children, 0) AS n_children FROM n LEFT JOIN ch ON n.d = ch.d AND n.k = ch.k
), s AS (
  SELECT a.d, a.k, count(*) FILTER (m.n_children = 0) AS n_leaves, sum((m.n_convs - 1) * m.w) AS saved
  FROM m JOIN p a ON a.c = m.conv AND a.d <= m.d GROUP BY a.d, a.k
)
SELECT m.conv AS conv_id, m.d::BIGINT AS depth, u.conv AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves,
       s.saved::BIGINT AS saved_tokens, m.ends AS ends_sha256
FROM m JOIN s ON m.d = s.d AND m.k = s.k LEFT JOIN n u ON u.d = m.d - 1 AND u.k = m.pk
"""


@query("op12_prefix_trie", _SQL)
def op12(spark: SparkSession, d: str) -> DataFrame:
    """Null conv_ids belong to no conversation; turns of equal number are ordered
    by the digest of role and text, repeated ones all count; other columns are
    not read."""
    return trie(rebuilt(load_table(spark, d, "conversations")))
