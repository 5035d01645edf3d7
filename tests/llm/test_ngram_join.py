import random
import re

import numpy as np
import pytest

from cascara.llm.catalog import QUERIES
from cascara.llm.ngram_join import Orders, SLOTS, jaccard_groups, shingle_set
from cascara.sources.tables import load_table
from llm_fixtures import docs, no_docs  # noqa: F401
from conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CAPITALS = {ord("A") + i: ord("a") + i for i in range(26)}


def brute_set(text, shingle=4):
    w = WORD.findall((text or "").translate(CAPITALS))
    return {tuple(w)} if 0 < len(w) < shingle else {tuple(w[i:i + shingle]) for i in range(len(w) - shingle + 1)}


def brute(rows, percent=85, shingle=4):
    """(doc_id, set size, component) of each (doc_id, text), all pairs compared
    (those of sets that share a shingle)."""
    sets = [brute_set(t, shingle) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    first, near = {}, {}
    for i, s in enumerate(sets):
        for x in s:
            near.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        if s and frozenset(s) in first:
            root[find(i)] = find(first[frozenset(s)])
            continue
        first[frozenset(s)] = i
        for j in {j for x in s for j in near[x] if j < i}:
            if find(i) != find(j):
                both = len(s & sets[j])
                if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        r = find(i)
        if k is not None:
            least[r] = min(k, least.get(r, k))
    return sorted((known(k), len(sets[i]), least.get(find(i), -1)) for i, (k, _) in enumerate(rows))


def known(k):
    return -1 if k is None else k


def got(out):
    return sorted((known(r["doc_id"]), r["n_shingles"], known(r["component_id"])) for r in out.collect())


def texts_near(rng, n):
    """Groups of copies with few or many edits, sharing passages."""
    words = [f"w{i}" for i in range(4000)]
    passage, out = rng.choices(words, k=40), []
    while len(out) < n:
        base = rng.choices(words, k=rng.choice([3, 4, 30, 90, 150])) + (passage if rng.random() < 0.5 else [])
        for _ in range(rng.choice([1, 2, 30])):
            t = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                t[rng.randrange(len(t))] = rng.choice(words)
            out.append(" ".join(t))
    rng.shuffle(out)
    return list(enumerate(out[:n], 1))


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"block": 3, "few": 0}), (3, {"block_tokens": 400, "orders": 1}),
                                           (4, {"percent": 60, "shingle": 2, "block": 7, "few": 3})])
def test_components_equal_brute_force(spark, seed, options):
    rows = texts_near(random.Random(seed), 400)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows, options.get("percent", 85), options.get("shingle", 4))
    assert got(jaccard_groups(table, **options)) == want
    assert len({c for _, _, c in want}) < 0.8 * len(rows)


def test_edge_cases(spark, docs, no_docs):
    out = jaccard_groups(docs)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(out) == brute(rows)
    assert jaccard_groups(no_docs).count() == 0
    extra = spark.createDataFrame([(1, "A b C d e", 1, "x", 2), (2, "a B c D e", 3, "y", 4), (3, None, 5, "z", 6),
                                   (None, "a b c d e", 7, "w", 8), (2, "a B c D e", 3, "y", 4)],
                                  "doc_id long, text string, node int, digest string, k1 int")
    assert got(jaccard_groups(extra)) == [(-1, 2, 1), (1, 2, 1), (2, 2, 1), (2, 2, 1), (3, 0, 3)]
    with pytest.raises(ValueError):
        jaccard_groups(docs, percent=0)


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in load_table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    assert got(QUERIES["op11_ngram_join"](spark, SF_SMALL)) == brute(rows)


def test_sets_and_prefixes():
    for t in ("", " \n", "a", "A b", "a b c d", "x y z x y z x y z", "é É ß\x0bk\x85l m"):
        assert len(shingle_set(t, 4)) == len(brute_set(t))
    assert (shingle_set("A B c", 4) == shingle_set("a b  C", 4)).all()
    assert not np.isin(shingle_set("a b c", 4), shingle_set("a b c a", 4)).any()
    counts = np.zeros(SLOTS, dtype=np.int64)
    s = shingle_set(" ".join(f"w{i}" for i in range(103)), 4)
    counts[(s[:50] >> np.uint64(44)).astype(int)] = 9
    orders = Orders(counts, 85, 3)
    assert len(s) == 100 and [len(orders.prefix(s, k)) for k in range(3)] == [16] * 3
    assert not np.isin(orders.prefix(s, 0), s[:50]).any() and len(orders.prefix(s, 0, 4)) == 19
    for _ in range(200):  # near sets share so many tokens of longer prefixes
        t = np.sort(np.concatenate((np.random.default_rng(_).choice(s, 93, replace=False), s[:5] + np.uint64(1))))
        if 100 * np.isin(s, t).sum() >= 85 * len(np.union1d(s, t)):
            for k in range(3):
                assert np.isin(orders.prefix(s, k, 4), orders.prefix(t, k, 4)).sum() >= 4
    assert len(set(map(bytes, (np.sort(orders.prefix(s, k)).tobytes() for k in range(3))))) == 3
