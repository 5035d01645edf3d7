import hashlib
import random
import re
from collections import defaultdict
from zlib import crc32

import pytest

from cascara.llm.catalog import ORACLE, QUERIES
from cascara.llm.prefix_trie import RESULT, rebuilt, trie
from cascara.sources.tables import load_table
from conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ROW = "conv_id long, turn int, role string, text string, turns string, key string, words string, g string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = crc32(str(c).encode()) % 4
        base = c - int(abs(c) % 20) * (1 if c >= 0 else -1)
        turns = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[x] for x in children[path]) or 1
        own_words = len(WORD.findall(path[-1][1])) if path else 0
        saved[path] = (len(members[path]) - 1) * own_words + sum(saved[x] for x in children[path])
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -10**9, len(m), len(children[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
                  for p, m in members.items())


def run(spark, rows, **options):
    table = spark.createDataFrame([(*r, *"abcd") for r in rows], ROW).repartition(3)
    out = trie(rebuilt(table), **options)
    assert out.columns == list(RESULT)
    return sorted(tuple(-10**9 if x is None else x for x in r) for r in out.collect())


def test_edge_cases(spark):
    rows = [(0, 0, "user", "a b"), (0, 1, "assistant", "c"), (0, None, None, None), (0, 1, "assistant", "c"),
            (3, 5, "user", ""), (3, 6, "", "user"), (7, 0, "user", "a b"), (7, 1, "assistant", None),
            (21, 0, "x", "base is absent"), (-1, 0, "user", "negative"), (-20, 2, "user", "its base"),
            (None, 0, "user", "no conversation"), (40, 0, "user", "long " * 5000)]
    rows += [(c, t, "user", f"deep {t}") for c in (60, 61, 62) for t in range(100 + c)]
    rows += [(c, t, "user", "same first") for c in range(100, 180) for t in range(2)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, rows[:1]) == brute(rows[:1])


@pytest.mark.parametrize("seed", range(3))
def test_shards_recombine(spark, seed):
    """Few turns and many equal conversations: nodes lie in many shards."""
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "b c", ""]) if rng.random() < 0.3 else "a")
            for c in rng.sample(range(2000), 400) for t in range(rng.choice([0, 1, 1, 2, 3, 12, 20]))]
    assert run(spark, rows, shard_turns=15) == run(spark, rows) == brute(rows)


def test_query(spark):
    rows = [tuple(r) for r in load_table(spark, SF_SMALL, "conversations").select(
        "conv_id", "turn", "role", "text").collect()]
    out = QUERIES["op12_prefix_trie"](spark, SF_SMALL)
    assert sorted(tuple(-10**9 if x is None else x for x in r) for r in out.collect()) == brute(rows)
    assert "op12_prefix_trie" in ORACLE
