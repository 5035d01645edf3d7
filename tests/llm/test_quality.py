import math
import random
import re

from pyspark.sql import functions as F

from cascara.llm import quality_model as qm
from cascara.llm.catalog import QUERIES
from cascara.llm.quality_rules import RULES, STEPS, base_counts, binomial_cdf, choose_cutoff, judge
from cascara.sources.tables import load_table
from llm_fixtures import docs, no_docs  # noqa: F401
from conftest import SF_MID


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    tri = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, t in enumerate(tri) if tri.count(t) > 1 for j in (i, i + 1, i + 2)}
    return (len(words), len("".join(words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_base_counts():
    rng = random.Random(1)
    for n in range(200):
        text = "".join(rng.choice(["a", "b", "é ", " ", "\n", "#", "a b c ", " "]) for _ in range(rng.randint(0, 80)))
        assert base_counts(text) == brute_counts(text), text
    assert base_counts(None) == base_counts("") == (0,) * 6


def test_binomial_cdf():
    for n, p in ((1, 0.3), (40, 0.05), (300, 0.01)):
        for k in (0, 1, n // 2, n):
            want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(min(k, n) + 1))
            assert abs(binomial_cdf(k, n, p) - want) < 1e-9


def test_choice_keeps_the_guarantee():
    # 2000 good documents, one above the third cutoff, many above the last.
    good, bad = [1900, 99, 1, 0, 0], [5, 5, 5, 5, 80]
    at = choose_cutoff(good, bad, 0.01, 0.001, 1.0)
    assert at == 2  # step 2 rejects one good document, step 3 a hundred
    assert choose_cutoff([20, 0, 0, 0, 0], bad, 0.01, 0.001, 1.0) == -1  # too few to tell
    assert choose_cutoff(good, [9, 0, 0, 0, 0], 0.01, 0.001, 1.0) == -1  # nothing gained


def test_guarantee_holds_in_simulation():
    # True false rejection rate at each step grows; the chosen one rarely breaks the limit.
    rng, alpha, level = random.Random(4), 0.02, 0.05
    above = [0.001, 0.01, 0.019, 0.03, 0.08]
    broken = 0
    for _ in range(300):
        good = [0] * 6
        for _ in range(800):
            u = rng.random()
            good[sum(u < a for a in above)] += 1
        at = choose_cutoff(good, [0, 90, 90, 90, 90, 90], alpha, level, 0.0)
        broken += at >= 3
    assert broken <= 300 * level + 3 * math.sqrt(300 * level)


def test_judge(spark, docs, no_docs):
    words = [f"good{i}" for i in range(400)]
    rng = random.Random(9)
    rows = [(k, " ".join(rng.choices(words, k=120)) + (" ### *** |||" * 40 if k % 5 == 0 else ""), "en" if k % 3 else None)
            for k in range(9000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = table.select("doc_id", (F.col("doc_id") % 5 != 0).cast("int").alias("quality"))
    labels = labels.unionAll(labels.limit(50)).unionAll(spark.createDataFrame(
        [(1, None), (None, 1), (10**9, 0)], labels.schema))
    out = judge(table, labels).groupBy((F.col("doc_id") % 5 == 0).alias("bad"), "kept").count().collect()
    assert {(r["bad"], r["kept"]): r["count"] for r in out} == {(True, False): 1800, (False, True): 7200}
    edge = judge(docs, labels)
    assert edge.count() == docs.count()
    for r in edge.collect():
        if r["n_words"] < 50:
            assert r["base_failed"] and not r["kept"]
    assert judge(no_docs, labels).count() == 0
    free = judge(table.limit(500), labels.limit(0))
    assert free.where("kept = base_failed").count() == 0
    assert set(RULES) == {"long_words", "short_words", "symbols", "same_lines", "repeats"}


def test_copies_are_one_draw(spark):
    """A good document, however often it is repeated or copied under other ids,
    allows no cutoff; with bad ones about, others stay."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    good = " ".join(rng.choices(words, k=100))
    rows = [(k, good, "en") for k in range(2000)] + [(0, good, "en")] * 500
    rows += [(5000 + k, " ".join(rng.choices(words, k=90)) + " ### ***" * k, "en") for k in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = table.select("doc_id", (F.col("doc_id") < 5000).cast("int").alias("quality")).distinct()
    out = judge(table, labels.unionAll(labels))
    assert out.where("size(broken) > 0").count() == 0 and out.where("NOT kept AND NOT base_failed").count() == 0


def brute_judge(rows, good, alpha=0.05, delta=0.05, cost=10.0):
    """kept by doc_id, from (doc_id, text, stratum) rows and labels."""
    def values(c):
        n_words, chars, symbols, lines, same, repeat = c
        per = lambda x, n: x / n if n else None
        got = {"long_words": per(chars, n_words), "symbols": per(symbols, n_words), "same_lines": per(same, lines),
               "repeats": per(repeat, n_words)}
        got["short_words"] = None if got["long_words"] is None else -got["long_words"]
        return got

    def rejected(v, step):
        return any(v[r] is not None and v[r] > ladder[step] for r, (_, ladder) in RULES.items())

    counts = {i: brute_counts(t) for i, t, _ in rows}
    failed = {i: c[0] < 50 or 2 * c[5] > c[0] for i, c in counts.items()}
    draws = {}
    for i, t, s in rows:
        if i in good and not failed[i]:
            old = draws.get((s, t), (values(counts[i]), True))
            draws[s, t] = old[0], old[1] and good[i]
    strata = {s for s, _ in draws}
    step_of = {}
    for s in strata:
        mine = [d for (x, _), d in draws.items() if x == s]
        n, best = sum(g for _, g in mine), 0.0
        for step in range(STEPS):
            wrong = sum(g and rejected(v, step) for v, g in mine)
            if not n or binomial_cdf(wrong, n, alpha) > delta / len(strata):
                break
            gain = sum(not g and rejected(v, step) for v, g in mine) - cost * wrong
            if gain > best:
                best, step_of[s] = gain, step
    return {i: (failed[i], not failed[i] and not (s in step_of and rejected(values(counts[i]), step_of[s])))
            for i, _, s in rows}


def test_query_equals_brute_force(spark):
    docs, labels = (load_table(spark, SF_MID, t) for t in ("documents", "labels"))
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    good = {}
    for r in labels.where("quality IS NOT NULL").collect():
        good[r["doc_id"]] = good.get(r["doc_id"], True) and r["quality"] == 1
    want = brute_judge(rows, good)
    out = QUERIES["op4_quality_rules"](spark, SF_MID).collect()
    assert {r["doc_id"]: (r["base_failed"], r["kept"]) for r in out} == want
    texts = {i: t for i, t, _ in rows}
    for r in out:
        assert (r["n_words"], r["word_chars"], r["n_symbols"]) == brute_counts(texts[r["doc_id"]])[:3]
        assert (r["n_dup_lines"], r["n_repeat_words"]) == brute_counts(texts[r["doc_id"]])[4:]
    # The rules are at work, and spare good documents.
    broken = [r["doc_id"] for r in out if r["broken"]]
    assert len(broken) >= 5
    lost = [i for i in broken if good.get(i)]
    assert len(lost) <= 0.05 * sum(good.values())


def test_held_out_accuracy(spark):
    docs, labels = load_table(spark, SF_MID, "documents"), load_table(spark, SF_MID, "labels")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    out = qm.classify(docs, labels.where(half))
    assert out.columns[:len(docs.columns)] == docs.columns and out.count() == docs.count()
    held = out.join(labels.where(~half), "doc_id").select(
        ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"), "rejected").collect()
    kept = [r for r in held if r["good"]]
    assert sum(not r["rejected"] for r in kept) / len(kept) >= 0.95
    assert sum(r["good"] != r["rejected"] for r in held) / len(held) >= 0.85
    again = qm.classify(docs, labels.where(half))
    assert out.exceptAll(again).count() == 0


def test_classifier_edge_cases(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (5, 1, 1), (6, 1, None), (6, 1, 0), (7, 0, 0),
                                    (None, 1, 0), (9, None, 0)], "doc_id long, quality int, toxic int")
    out = qm.classify(docs, labels, least=1, z=0.0)
    assert out.count() == docs.count() and out.where("score IS NULL").count() == 0
    assert qm.classify(no_docs, labels).count() == 0
    for few in (labels.limit(0), labels.where("doc_id = 1")):
        assert qm.classify(docs, few).where("rejected").count() == 0


def test_a_clashing_id_has_one_model(spark):
    """Labels for an id with several texts: reruns over other partitions agree."""
    docs, labels = load_table(spark, SF_MID, "documents"), load_table(spark, SF_MID, "labels")
    clash = docs.withColumn("doc_id", F.col("doc_id") - F.col("doc_id") % 2)
    one = qm.classify(clash, labels, rounds=1)
    two = qm.classify(clash.repartition(7, "text").sortWithinPartitions("text"), labels, rounds=1)
    assert one.exceptAll(two).count() == 0


def test_views_teach_each_other():
    """``teach`` as the query calls it, over views that each tell half of the
    kinds apart: labels of one view help the other."""
    import numpy as np

    rng = np.random.default_rng(0)

    def draw(n):
        y = rng.integers(0, 2, n)
        a = [np.array([k if rng.random() < 0.95 else 1 - k]) for k in y]
        b = [np.array([k if rng.random() < 0.9 else 1 - k]) for k in y]
        return {"content": a, "layout": b}, y.astype(float)

    x, y = draw(30)
    pool, _ = draw(600)

    def fit(extra):
        return {v: qm.Logistic(2).fit(x[v] + [pool[v][i] for i, _ in extra[v]],
                                      np.concatenate([y, [label for _, label in extra[v]]])) for v in qm.VIEWS}

    def surest(models, extra):
        taken = {i for v in qm.VIEWS for i, _ in extra[v]}
        left = np.array([i for i in range(600) if i not in taken], dtype=np.int64)
        found = {}
        for v in qm.VIEWS:
            p = 1 / (1 + np.exp(-models[v].margin([pool[v][i] for i in left])))
            found[v] = [(int(left[i]), label) for label, q in ((1.0, p), (0.0, 1 - p))
                        for i in np.argsort(-q, kind="stable")[:50] if q[i] >= 0.8]
        return found

    models = qm.teach(fit, surest, 3)
    test, want = draw(500)
    for v in qm.VIEWS:
        assert ((models[v].margin(test[v]) > 0) == (want == 1)).mean() > 0.85
