"""Operator 11: an n-gram Jaccard join by multiple global orders.

A document is its set of word shingles, as 64-bit hashes. If two sets meet the
threshold, then under any order of all tokens their prefixes (the first
n - ceil(threshold * n) + 1 tokens) share a token. So candidates must share one
under each of several orders: rarest first, by counts over all documents, and by
two hashes.

1. Token counts are summed into ``SLOTS`` slots (one array of fixed size, the
   only thing broadcast). They steer the first order; any counts give right
   results.
2. Each document's set is reduced to a digest and its first prefix. Equal sets
   are one node, however many documents have them.
3. Nodes that share a token of the first prefix meet at that token. Prefixes are
   ``SHARED`` - 1 tokens longer than they need be, so that linked sets share
   ``SHARED`` tokens. Where at most ``FEW`` nodes meet, their pairs are counted:
   those that share fewer tokens, all of them such, are no candidates. Of a pair
   the node that meets most others is the pivot; a token that more nodes share has
   one pivot for all. Nodes with the same pivot are its neighbourhood. Hot passages
   are no prefix tokens, as these are the rarest.
4. Texts are sent to their neighbourhoods, in blocks of bounded size: block pairs
   where there are several. A task joins members that are not yet connected:
   prefixes under all orders are intersected, what is left is verified on whole
   sets. It hands on only links that connect; near copies of one text, each
   linked to the pivot, need one link each, not all pairs.
5. Links become components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascara.llm.common import PART_BYTES, load_table, materialize, query, text_or_empty
from cascara.llm.components import components

#: Token counts are kept for so many hashed slots: 8 MB.
_SLOT_BITS = 20
SLOTS = 1 << _SLOT_BITS
_CHUNKS = 64  # of the slots, for their sums
_SPREAD = 256  # partial sums of a chunk
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: Tokens that linked sets share at least; nodes of a token whose pairs are counted.
SHARED, FEW = 4, 8
#: Members of a neighbourhood that meet in a task, and tokens of their sets.
BLOCK, BLOCK_TOKENS = 2000, 2_000_000


def _slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = x + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for s, m in zip((30, 27), _MIX):
        x = (x ^ (x >> np.uint64(s))) * m
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Distinct shingles as sorted hashes: A-Z in lower case, words between ASCII
    white space; fewer words than a shingle are one, no words none."""
    words = (text or "").encode().lower().split()
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    size = min(shingle, len(h))
    if not size:
        return h
    out = _mixed(h[:len(h) - size + 1], size)
    for k in range(1, size):
        out = _mixed(out ^ _mixed(h[k:len(h) - size + 1 + k], k + 100), k)
    return np.unique(out)


class Orders:
    """The prefixes of a set under each global order."""

    def __init__(self, counts: np.ndarray, percent: int, n: int):
        self.counts, self.percent, self.n = counts, percent, n

    def prefix(self, tokens: np.ndarray, order: int, shared: int = 1) -> np.ndarray:
        """So long that linked sets share ``shared`` tokens (or all they have)."""
        size = len(tokens) + (-self.percent * len(tokens)) // 100 + shared if len(tokens) else 0
        if order:
            by = np.argsort(_mixed(tokens, order), kind="stable")
        else:
            by = np.lexsort((tokens, self.counts[_slot(tokens)]))
        return tokens[by[:size]]


def slot_counts(docs: DataFrame, shingle: int, text_col: str) -> np.ndarray:
    """In how many documents tokens of each slot occur (a token counts once a
    document). Partial sums by chunk, first within ``_SPREAD`` parts."""
    width = SLOTS // _CHUNKS

    def count(batches):
        total = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            for t in batch["text"]:
                np.add.at(total, _slot(shingle_set(t.as_py(), shingle)), 1)
        if total.any():
            from pyspark import TaskContext

            part = TaskContext.get().partitionId() % _SPREAD
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array(range(_CHUNKS), pa.int32()), "part": pa.array([part] * _CHUNKS, pa.int32()),
                "counts": pa.array([total[k * width:(k + 1) * width].astype("<i8").tobytes() for k in range(_CHUNKS)],
                                   pa.binary())})

    def add(frame):
        out = np.zeros(width, dtype=np.int64)
        for x in frame["counts"]:
            out += np.frombuffer(x, dtype="<i8")
        return frame.head(1).assign(counts=[out.tobytes()])

    schema = "chunk int, part int, counts binary"
    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(count, schema)
    parts = parts.groupBy("chunk", "part").applyInPandas(add, schema)
    rows = parts.groupBy("chunk").applyInPandas(add, schema).collect()  # SLOTS numbers
    out = np.zeros(SLOTS, dtype=np.int64)
    for r in rows:
        out[r["chunk"] * width:(r["chunk"] + 1) * width] = np.frombuffer(r["counts"], dtype="<i8")
    return out


def _sets(docs: DataFrame, shingle: int, orders) -> DataFrame:
    """(doc_id, k1, k2, node, digest, n, prefix) of each row: the prefix only for
    the first row of a task with that set; nodes are unique to rows."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        node, seen = TaskContext.get().partitionId() << 40, set()
        for batch in batches:
            step = max(1, batch.num_rows * PART_BYTES // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                digests, sizes, prefixes = [], [], []
                for t in part["text"]:
                    tokens = shingle_set(t.as_py(), shingle)
                    digest = xxhash.xxh3_128_digest(tokens.tobytes())
                    new = digest not in seen and len(tokens) > 0
                    seen.add(digest)
                    digests.append(digest)
                    sizes.append(len(tokens))
                    prefixes.append(orders.value.prefix(tokens, 0, SHARED).view(np.int64) if new else None)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["k1"], part["k2"], pa.array(range(node, node + n), pa.int64()),
                     pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
                     pa.array(prefixes, pa.list_(pa.int64()))],
                    names=["doc_id", "k1", "k2", "node", "digest", "n", "prefix"])
                node += n

    return docs.mapInArrow(run, f"doc_id {kind}, k1 long, k2 long, node long, digest binary, n long, "
                                "prefix array<long>")


def neighbourhoods(rows: DataFrame, reps: DataFrame, percent: int, few: int) -> DataFrame:
    """(node, pivot): all nodes that may be linked are both in the neighbourhood of
    some pivot; a pivot is a member of its own."""
    entries = rows.where("prefix IS NOT NULL").select("node", F.explode("prefix").alias("token"))
    by_token = "OVER (PARTITION BY token)"
    met = (entries.selectExpr("node", "token", f"min(node) {by_token} AS lo", f"max(node) {by_token} AS hi")
           .where("lo < hi").select("node", "token"))
    # Rows of different tasks may have the same set.
    named = rows.where("prefix IS NOT NULL").select("node", "digest", "n").join(reps, "digest").select("node", "rep", "n")
    met = (met.join(named, "node").select(F.col("rep").alias("node"), "n", "token").distinct()
           .selectExpr("node", "n", "token", f"count(1) {by_token} AS m").where("m > 1"))
    met = materialize(met, "met")
    central = met.groupBy("node").agg(F.sum("m").alias("central"))
    met = materialize(met.join(central, "node").select("token", "m", F.struct("central", "node", "n").alias("x")), "met")
    # Few nodes at a token: at most few * (few - 1) / 2 pairs, the more central first.
    each = met.where(F.col("m") <= few).groupBy("token").agg(F.sort_array(F.collect_list("x"), asc=False).alias("xs"))
    pairs = (each.select("xs", F.posexplode("xs").alias("i", "a"))
             .select("a", F.explode(F.slice("xs", F.col("i") + 2, F.lit(few))).alias("b"))
             .groupBy(F.col("a.node").alias("pivot"), F.col("b.node").alias("node"))
             .agg(F.count(F.lit(1)).alias("shared"), F.first(F.greatest("a.n", "b.n")).alias("n")))
    pairs = pairs.where(F.col("shared") >= F.least(F.lit(SHARED), F.ceil(F.col("n") * percent / 100)))
    pairs = materialize(pairs.select("node", "pivot"), "pairs")
    hot = (met.where(F.col("m") > few).selectExpr("x.node AS node", f"max(x) {by_token} AS top")
           .select("node", F.col("top.node").alias("pivot")))
    return pairs.unionAll(pairs.select(F.col("pivot").alias("node"), "pivot")).unionAll(hot).distinct()


def _blocks(pairs: DataFrame, sizes: DataFrame, block: int, block_tokens: int) -> DataFrame:
    """(node, goes): to which (pivot, i, j) a node's text goes, and its block
    there. A pivot goes to all block pairs of its neighbourhood."""
    hood = (pairs.join(sizes, "node").groupBy("pivot")
            .agg(F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n") / block_tokens)).cast("int")
                 .alias("blocks")))
    b = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    each = F.sequence(F.lit(0), F.col("blocks") - 1)
    own = F.transform(each, lambda c: F.struct(F.least(c, F.col("b")).alias("i"), F.greatest(c, F.col("b")).alias("j")))
    every = F.flatten(F.transform(each, lambda i: F.transform(
        F.sequence(i, F.col("blocks") - 1), lambda j: F.struct(i.alias("i"), j.alias("j")))))
    return (pairs.join(hood, "pivot").withColumn("b", b)
            .withColumn("at", F.explode(F.when(F.col("node") == F.col("pivot"), every).otherwise(own)))
            .groupBy("node").agg(F.collect_list(F.struct("pivot", "at.i", "at.j", "b")).alias("goes")))


class _Meeting:
    """Joins the members of two blocks (or of one) of a neighbourhood."""

    def __init__(self, nodes: list[int], sides: list[int], sets: list[np.ndarray], orders: Orders):
        self.nodes, self.sets, self.orders = nodes, sets, orders
        self.side, self.n = np.array(sides), np.array(list(map(len, sets)))
        self.start = np.cumsum(self.n) - self.n
        self.flat = np.concatenate(sets)
        self.prefixes = [[orders.prefix(s, k) for s in sets] for k in range(orders.n)]
        self.postings = [self._postings(p) for p in self.prefixes]
        self.root = np.arange(len(nodes))

    @staticmethod
    def _postings(prefixes: list[np.ndarray]):
        flat = np.concatenate(prefixes)
        by = np.argsort(flat, kind="stable")
        return flat[by], np.repeat(np.arange(len(prefixes)), list(map(len, prefixes)))[by]

    def _sharing(self, x: int, order: int) -> np.ndarray:
        """Whether each member shares a token with x's prefix under an order."""
        tokens, members = self.postings[order]
        lo, hi = (np.searchsorted(tokens, self.prefixes[order][x], side=s) for s in ("left", "right"))
        out = np.zeros(len(self.nodes), dtype=bool)
        count = hi - lo
        out[members[np.arange(count.sum()) + np.repeat(lo - np.cumsum(count) + count, count)]] = True
        return out

    def links_of(self, x: int, wanted: np.ndarray) -> np.ndarray:
        """Which of the ``wanted`` members x is linked with."""
        p, n = self.orders.percent, self.n
        wanted = wanted & (100 * np.minimum(n, n[x]) >= p * np.maximum(n, n[x]))
        for k in range(self.orders.n):
            if not wanted.any():
                return np.zeros(0, dtype=np.int64)
            wanted &= self._sharing(x, k)
        at = np.flatnonzero(wanted)
        if not len(at):
            return at
        size = n[at]
        ends = np.cumsum(size)
        tokens = self.flat[np.arange(ends[-1]) + np.repeat(self.start[at] - ends + size, size)]
        mine = self.sets[x]
        found = mine[np.minimum(np.searchsorted(mine, tokens), len(mine) - 1)] == tokens
        both = np.add.reduceat(found.astype(np.int64), ends - size)
        return at[100 * both >= p * (size + n[x] - both)]

    def connect(self, x: int, others: np.ndarray):
        for y in others.tolist():
            if self.root[y] != self.root[x]:
                self.root[self.root == self.root[y]] = self.root[x]
                yield self.nodes[x], self.nodes[y]

    def links(self, pivot: int, one: bool):
        """Links that connect the members (of one block, or across two) as all
        their links would. Members of the pivot's component need no check among
        themselves: each pair outside it is met from a member that is not in it."""
        yield from self.connect(pivot, self.links_of(pivot, self.root != pivot))
        for x in range(len(self.nodes)):
            if self.root[x] != self.root[pivot]:
                wanted = self.root != self.root[x]
                yield from self.connect(x, self.links_of(x, wanted if one else wanted & (self.side != self.side[x])))


def _join(shingle: int, orders):
    """Rows sorted by neighbourhood and block pair to connecting links."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def joined(key, members):
        pivot, i, j = key
        nodes = list(members)
        sets = [shingle_set(members[n][1], shingle) for n in nodes]
        meeting = _Meeting(nodes, [members[n][0] for n in nodes], sets, orders.value)
        return list(meeting.links(nodes.index(pivot), i == j))

    def run(batches):
        key, members = None, {}
        for batch in batches:
            out = []
            for r in zip(*(batch[c] for c in ("pivot", "i", "j", "node", "b", "text"))):
                pivot, i, j, node, b = (x.as_py() for x in r[:5])
                if (pivot, i, j) != key:
                    if members:
                        out += joined(key, members)
                    key, members = (pivot, i, j), {}
                members[node] = b, r[5].as_py()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], schema=schema)
        if members and (out := joined(key, members)):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], schema=schema)

    return run


def jaccard_groups(docs: DataFrame, shingle: int = 4, percent: int = 85, orders: int = 3,
                   id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK,
                   block_tokens: int = BLOCK_TOKENS, few: int = FEW) -> DataFrame:
    """(doc_id, n_shingles, node, component_id) for every row of ``docs``.

    Rows link where 100 * intersection >= ``percent`` * union of their shingle
    sets; component_id is the smallest doc_id that links lead to, the row's own
    included; node is the same for rows of equal sets (null: an empty set).

    Null and empty texts, and those of white space, have an empty set and are
    linked with nothing: component_id is the row's own id. A null doc_id takes
    part and is never the smallest unless its group has no other. Repeated rows
    stay. Other columns are ignored; an empty table gives an empty result. Sets
    and digests are compared by 64 and 128 bits.
    """
    if not 0 < percent <= 100 or orders < 1 or shingle < 1:
        raise ValueError("percent is 1 to 100; orders and shingle are positive")
    spark, text = docs.sparkSession, text_or_empty(text_col)
    ident = F.col(id_col)
    docs = docs.select(ident.alias("doc_id"), text.alias("text"),
                       F.xxhash64(ident.isNull(), ident, text).alias("k1"),
                       F.xxhash64(F.lit(1), text, ident.isNull(), ident).alias("k2"))
    known = spark.sparkContext.broadcast(Orders(slot_counts(docs, shingle, "text"), percent, orders))
    rows = materialize(_sets(docs, shingle, known), "sets")
    reps = materialize(rows.where("n > 0").groupBy("digest").agg(
        F.min("node").alias("rep"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id")).alias("least"),
        F.min(F.struct("node", "k1", "k2", "n")).alias("r")), "nodes")
    nodes = reps.select("r.node", "r.k1", "r.k2", "r.n")
    pairs = materialize(neighbourhoods(rows, reps.select("digest", "rep"), percent, few), "neighbourhoods")
    goes = _blocks(pairs, nodes.select("node", "n"), block, block_tokens).join(nodes.select("node", "k1", "k2"), "node")
    sent = (docs.select("k1", "k2", "text").join(goes, ["k1", "k2"])
            .select("node", "text", F.explode("goes").alias("g"))
            .select("g.pivot", "g.i", "g.j", "node", "g.b", "text")
            .repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j"))
    links = materialize(sent.mapInArrow(_join(shingle, known), "a long, b long"), "links")
    found = components(links, "a", "b")
    labelled = (reps.select("digest", F.col("rep").alias("node"), "least")
                .join(found, "node", "left").withColumn("root", F.coalesce("root", "node")))
    labelled = materialize(labelled, "labelled")
    smallest = labelled.groupBy("root").agg(F.min("least").alias("least"))
    labels = labelled.select("digest", "node", "root").join(smallest, "root").select(
        "digest", "node", F.col("least.doc_id").alias("component_id"))
    full, empty = rows.where("n > 0"), rows.where("n = 0")
    return (full.select("doc_id", F.col("n").alias("n_shingles"), "digest").join(labels, "digest")
            .select("doc_id", "n_shingles", "node", "component_id")
            .unionAll(empty.select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("node"),
                                   F.col("doc_id").alias("component_id"))))


@query("op11_ngram_join")
def op11(spark: SparkSession, d: str) -> DataFrame:
    return jaccard_groups(load_table(spark, d, "documents")).select("doc_id", "n_shingles", "component_id")
