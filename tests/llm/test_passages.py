import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from cascara.llm import decontaminate as dc
from cascara.llm.automaton import CompactAutomaton, SuffixAutomaton
from cascara.llm.substring_dedup import References, remove_repeats
from cascara.sources.tables import load_table
from llm_fixtures import docs, no_docs  # noqa: F401
from conftest import SF_SMALL


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=12), max_size=5), st.lists(st.integers(0, 3), max_size=20))
def test_matching_statistics(sequences, text):
    sam = SuffixAutomaton()
    for s in sequences:
        sam.add(s)
    there = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)} | {()}
    for i, (_, n) in enumerate(sam.matching(text), 1):
        assert n == max(k for k in range(i + 1) if tuple(text[i - k:i]) in there)
    assert len(sam.link) <= 2 * sum(map(len, sequences)) + 1
    assert list(CompactAutomaton(sam).matching(text)) == list(sam.matching(text))


def brute_repeats(rows, window):
    words = [(k, (t or "").encode().split()) for k, t in rows]
    first = {}
    for k, w in words:
        for i in range(len(w) - window + 1):
            x, k_ = tuple(w[i:i + window]), float("inf") if k is None else k
            first[x] = min(first.get(x, k_), k_)
    out = []
    for k, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (float("inf") if k is None else k):
                gone |= set(range(i, i + window))
        out.append((k, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=str)


def found_repeats(df, **options):
    out = remove_repeats(df, **options).select("doc_id", "n_words", "n_removed", "kept")
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("shard_words", [100_000, 30, 1])
def test_repeats_equal_brute_force(spark, shard_words):
    rng = random.Random(shard_words)
    pool = [[rng.choice("abc") * rng.randint(1, 2) for _ in range(rng.randint(4, 14))] for _ in range(12)]
    rows = []
    for k in range(120):
        parts = [rng.choice(pool) if rng.random() < 0.6 else
                 [rng.choice("abcdefgh") for _ in range(rng.randint(0, 9))] for _ in range(rng.randint(0, 6))]
        rows.append((rng.choice([k, k, k, k // 2, None]), rng.choice([" ", "\n ", "\t"]).join(w for p in parts for w in p)))
    rows += [(3, None), (500, "a " * 70), (501, "a " * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = found_repeats(df, window=7, gram=3, shard_words=shard_words)
    assert got == brute_repeats(rows, 7)
    assert any(r[2] for r in got)


def test_an_anchor_in_thousands_of_variants(spark):
    """Copies of one passage, each with words of its own, and a phrase that all
    share between other words: several shards for one group."""
    rng = random.Random(8)
    base, phrase = [f"b{i}" for i in range(70)], [f"p{i}" for i in range(14)]
    rows = []
    for k in range(2500):
        copy = list(base)
        copy[rng.randrange(70)] = f"x{k}"
        other = [f"y{k}-{i}" for i in range(30)] + phrase + [f"z{k}-{i}" for i in range(30)]
        rows.append((k, " ".join(copy + other)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert found_repeats(df, window=20, gram=6, shard_words=20_000) == brute_repeats(rows, 20)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=3, max_size=14), min_size=1, max_size=6))
def test_references_know_the_first_document(sequences):
    refs, first, w = References(3), {}, 3
    for doc, words in enumerate(sequences):
        windows = [tuple(words[i:i + w]) for i in range(len(words) - w + 1)]
        got = refs.known(words)
        assert got == [first.get(x) for x in windows]
        refs.learn(doc, words, [g is None for g in got])
        for x in windows:
            first.setdefault(x, doc)


def test_repeats_of_the_edge_cases(spark, docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    out = remove_repeats(docs)
    assert set(docs.columns) <= set(out.columns)
    assert found_repeats(docs) == brute_repeats(rows, 50)
    assert remove_repeats(no_docs).count() == 0


def brute_hits(text, items, window):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(
        rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    hit, names = set(), set()
    for name, item in items:
        w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (item or "").encode().lower())
        k = min(window, len(w))
        windows = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if k else set()
        for i in range(len(words) - k + 1):
            if k and tuple(words[i:i + k]) in windows:
                hit |= set(range(i, i + k))
                names.add(name)
    return len(words), len(hit), sorted(names)


@pytest.mark.parametrize("shard_bytes", [1 << 20, 60])
def test_hits_equal_brute_force(spark, shard_bytes):
    rng = random.Random(3)
    word = lambda: rng.choice(["a", "B", "c", "dé", "4"])
    items = [(f"i{k}", rng.choice([" ", "-", ", "]).join(word() for _ in range(rng.randint(0, 12)))) for k in range(15)]
    items += [("none", None), ("dots", "... !"), ("i1", "a a a a a"), ("i1", "a a a a a")]
    docs = [(k, rng.choice([" ", "\n"]).join(word() for _ in range(rng.randint(0, 60)))) for k in range(80)]
    docs += [(1, None), (None, "a b c"), (2, ""), (2, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    out = dc.decontaminate(df, bench, window=5, shard_bytes=shard_bytes)
    got = sorted([(r["doc_id"], r["text"], r["n_words"], r["n_hit"], r["items"]) for r in out.collect()], key=str)
    assert got == sorted([(k, t, *brute_hits(t, items, 5)) for k, t in docs], key=str)


def test_hits_of_tables(spark, docs, no_docs):
    table, bench = load_table(spark, SF_SMALL, "documents"), load_table(spark, SF_SMALL, "benchmark")
    items = [(str(r["item_id"]), r["text"]) for r in bench.collect()]
    for df in (table, docs):
        rows = dc.decontaminate(df, bench).collect()
        assert len(rows) == df.count()
        for r in rows:
            assert (r["n_words"], r["n_hit"], r["items"]) == brute_hits(r["text"], items, 10)
    assert dc.decontaminate(no_docs, bench).count() == 0
    assert dc.decontaminate(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_an_automaton_in_bounded_memory(monkeypatch, spark, docs):
    """About 2 MB of items, and shards that are split where they measure too large."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(30_000)]
    items = [(str(i), " ".join(rng.choices(words, k=120))) for i in range(2600)]
    built = dc.Items(items, 10)
    assert sum(len(t) for _, t in items) > 1.7e6 and built.nbytes < dc.AUTOMATON_BYTES
    rows = [(i, " ".join(rng.choices(words, k=30)) + " " + items[i][1][:200]) for i in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items[:60], "item_id string, text string")
    whole = dc.decontaminate(table, bench).select("doc_id", "n_hit", "items").collect()
    monkeypatch.setattr(dc, "AUTOMATON_BYTES", 400_000)
    split = dc.decontaminate(table, bench).select("doc_id", "n_hit", "items").collect()
    assert sorted(whole) == sorted(split) and all(r["n_hit"] for r in whole)


def test_spans_leave_the_text(spark):
    items = [("q", "what is the capital of the old kingdom by the sea")]
    text = "Intro. What is the capital -- of the OLD kingdom, by the sea? Outro é."
    df = spark.createDataFrame([(1, text), (2, items[0][1]), (3, "nothing here")], "doc_id long, text string")
    out = {r["doc_id"]: r for r in dc.decontaminate(
        df, spark.createDataFrame(items, "item_id string, text string")).collect()}
    assert out[1]["clean"] == "Intro. ? Outro é." and out[1]["refused"] == (11 > 0.5 * 13)
    assert out[2]["clean"] == "" and out[2]["refused"]
    assert out[3]["clean"] == "nothing here" and not out[3]["refused"]
