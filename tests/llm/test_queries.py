import os
import sys

import pytest

import corpus_pipeline as cp
from cascara.llm.catalog import ORACLE, QUERIES
from cascara.session import materialize
from cascara.sources.tables import load_table
from llm_fixtures import docs, no_docs  # noqa: F401
from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
from oracle_check import compare, duck  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    ok, message = compare(spark, duck(SF_SMALL), name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert ok, message


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op5_chat_format", "op12_prefix_trie"}))
def test_one_row_per_document(spark, name):
    out = QUERIES[name](spark, SF_SMALL).select("doc_id").collect()
    ids = load_table(spark, SF_SMALL, "documents").select("doc_id").collect()
    assert sorted(r[0] for r in out) == sorted(r[0] for r in ids)


def test_pipeline_is_its_stages(spark):
    """Each stage against what the operator's query says of the same input."""
    docs = load_table(spark, SF_SMALL, "documents")
    kept = {}
    for name, stage in cp.STAGES:
        before, docs = docs, materialize(stage(spark, docs, SF_SMALL), name)
        kept[name] = docs
        if name != cp.STAGES[-1][0]:
            assert docs.columns == cp.COLUMNS
    rows = {n: [r["doc_id"] for r in d.select("doc_id").collect()] for n, d in kept.items()}
    first = QUERIES["op9_quality_model"](spark, SF_SMALL)
    assert sorted(rows["quality_classifier"]) == sorted(r[0] for r in first.where("kept").select("doc_id").collect())
    from test_near_duplicates import brute_fingerprint, brute_links, signed, union_find

    texts = {r["doc_id"]: r["text"] for r in kept["quality_classifier"].collect()}
    fp = {k: signed(brute_fingerprint(t)) for k, t in texts.items()}
    root = union_find(set(fp.values()), brute_links(sorted(set(fp.values())), 3))
    least = {}
    for k in sorted(fp):
        least.setdefault(root[fp[k]], k)
    assert sorted(rows["simhash_near_dedup"]) == sorted(least.values())
    from test_passages import brute_hits

    items = [(str(r["item_id"]), r["text"]) for r in load_table(spark, SF_SMALL, "benchmark").collect()]
    clean = {r["doc_id"]: r for r in kept["benchmark_decontamination"].collect()}
    for k in rows["simhash_near_dedup"]:
        n, hit, _ = brute_hits(texts[k], items, 10)
        assert (k in clean) == (hit <= 0.5 * n)
        if k in clean:
            assert (clean[k]["text"] == texts[k]) == (hit == 0)
            assert brute_hits(clean[k]["text"], items, 10)[0] == n - hit
    from test_tokens import plain

    mixed = kept["source_mix"].collect()
    assert {r["doc_id"] for r in mixed} <= set(clean)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in kept["token_records"].collect()) == sorted(
        (r["doc_id"], len(plain(r["text"])) + 1) for r in mixed)


def test_pipeline_edge_cases(spark, docs, no_docs):
    for table in (docs, no_docs):
        out = table
        for name, stage in cp.STAGES:
            out = materialize(stage(spark, out, SF_SMALL), name)
        assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
