import random
import re

import numpy as np
import xxhash

from cascara.llm.components import components
from cascara.llm.golay import near, tables
from cascara.llm.simhash import links, near_duplicates, one_of_each
from cascara.session import materialize, watch_materialized
from cascara.sources.tables import load_table
from corpus_pipeline import simhash_near_dedup
from llm_fixtures import docs, no_docs  # noqa: F401
from conftest import SF_SMALL


def test_golay_code():
    high, error = tables()
    assert ((error >= 0).sum(axis=1) == np.where(
        np.array([bin(e).count("1") for e in error[:, 0]]) == 3, 6, 1)).all()
    rng = np.random.default_rng(1)
    v = rng.integers(0, 1 << 23, 20_000)
    u = v ^ (1 << rng.integers(0, 23, 20_000))
    assert (near(u) == near(v)[:, :1]).any(axis=1).all()


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_links(fps, bits):
    return {(min(a, b), max(a, b)) for i, a in enumerate(fps) for b in fps[:i]
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= bits}


def test_links_equal_brute_force(spark):
    rng = random.Random(5)
    fps = {0, signed((1 << 64) - 1)}
    for _ in range(60):
        x = rng.getrandbits(64)
        fps.add(signed(x))
        for _ in range(12):
            y = x
            for b in rng.sample(range(64), rng.randint(1, 5)):
                y ^= 1 << b
            fps.add(signed(y))
    fps = sorted(fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    for bits in (3, 1):
        got = {tuple(r) for r in links(df, bits).collect()}
        assert got == brute_links(fps, bits)
        assert got


def test_links_broadcast_neither_side(spark):
    # A fingerprint makes up to 108 keys, while Spark sizes them as one row.
    fps = materialize(spark.createDataFrame([(1,), (2,)], "fp long"), "fps")  # a written table has a known size
    plan = links(fps)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def union_find(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(-40, 0)]
    star = [(1000, x) for x in range(500, 560)]
    rand = [(rng.randint(2000, 2200), rng.randint(2000, 2200)) for _ in range(120)]
    for pairs in (chain + star + rand, []):
        got = components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()
        want = union_find({x for p in pairs if p[0] != p[1] for x in p}, pairs)
        assert {r["node"]: r["root"] for r in got} == want and len(got) == len(want)


def brute_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_groups_equal_brute_force(spark, docs, no_docs):
    for df in (load_table(spark, SF_SMALL, "documents"), docs.select("doc_id", "text")):
        rows = [(r["doc_id"], signed(brute_fingerprint(r["text"]))) for r in df.collect()]
        fps = sorted({fp for _, fp in rows})
        root = union_find(fps, brute_links(fps, 3))
        least = {}
        for k, fp in rows:
            if k is not None:
                least[root[fp]] = min(k, least.get(root[fp], k))
        want = sorted([(k, fp, least.get(root[fp])) for k, fp in rows], key=str)
        got = near_duplicates(df)
        assert sorted([(r["doc_id"], r["fp"], r["component_id"]) for r in got.collect()], key=str) == want
        kept = one_of_each(df).collect()
        assert len(kept) == len(set(root.values()))
        assert sorted(str(r["doc_id"]) for r in kept) == sorted(str(least.get(x)) for x in set(root.values()))
    assert near_duplicates(no_docs).count() == 0 and one_of_each(no_docs).count() == 0


def test_pipeline_stage_broadcasts_no_links(spark, docs):
    plans = {}
    with watch_materialized(lambda df, name: plans.setdefault(
            name, df._jdf.queryExecution().executedPlan().toString())):
        simhash_near_dedup(spark, docs, SF_SMALL).collect()
    assert "SortMergeJoin" in plans["edges"] and "BroadcastExchange" not in plans["edges"]
