"""Generated-input properties (hypothesis): each example is one Spark job
compared with a plain-Python statement of the same semantics."""

from collections import Counter
from itertools import combinations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cascara.functions import strip_split
from cascara.operators import itemsets as I
from cascara.operators import tables as T
from test_tables import _py_histogram

SLOW = settings(max_examples=12, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])

TEXT = st.text(alphabet=st.sampled_from(list("ab#x ") + ["\t", "\r", "\n", " ", "　",
                                                          "​", "\x1c"]), max_size=12)


@SLOW
@given(st.lists(TEXT, min_size=1, max_size=30))
def test_strip_split_equals_python(spark, lines):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(strip_split("v")).collect()]
    assert got == [x.strip().split(" ") for x in lines]


@SLOW
@given(st.lists(st.one_of(st.none(), st.just(float("nan")), st.floats(-2, 12)), max_size=40),
       st.lists(st.integers(-1, 11), min_size=2, max_size=6, unique=True))
def test_histogram_equals_python(spark, values, edges):
    edges = sorted(edges)
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r["count"] for r in T.histogram_fixed(df, "x", edges).orderBy("bin").collect()]
    assert got == _py_histogram(values, edges)


BASKET = st.lists(st.sampled_from(["a", "b", "c", "d", "e", "f"]), max_size=6)


@settings(max_examples=4, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(BASKET, min_size=1, max_size=40), st.integers(0, 6), st.integers(0, 4))
def test_mining_equals_brute_force(spark, baskets, t_item, t_set):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(baskets)], "id int, items array<string>")
    got = I.frequent_itemsets(df, "items", t_item, t_set, max_len=3)
    got = [(r["level"], r["label"], r["count"]) for r in got.collect()]

    sets = [set(b) for b in baskets]
    cnt = Counter(x for s in sets for x in s)
    order = sorted((x for x in cnt if cnt[x] > t_item), key=lambda x: (-cnt[x], x))
    rank = {x: k for k, x in enumerate(order)}
    want = Counter()
    for s in sets:
        f = sorted((x for x in s if x in rank), key=rank.get)
        for L in (2, 3):
            for c in combinations(f, L):
                want[c] += 1
    rows = sorted(((len(c), [rank[x] for x in c], "-".join(c), n)
                   for c, n in want.items() if n > t_set))
    assert got == [(lv, label, n) for lv, _, label, n in rows]


DAY_LINES = st.lists(st.tuples(st.sampled_from([1, 2, 3]),
                               st.lists(st.sampled_from(["#a", "#B", "#b", "x", "#", ""]),
                                        max_size=5)), max_size=25)


@SLOW
@given(DAY_LINES)
def test_count_diff_forms_equal_python(spark, rows):
    import datetime as dt

    from cascara.operators.text import count_diff, count_diff_outer_join

    base = dt.date(2024, 1, 1)
    data = [(base + dt.timedelta(days=d - 1), " ".join(toks)) for d, toks in rows]
    df = spark.createDataFrame(data, "day date, value string")
    d1, d2 = base, base + dt.timedelta(days=1)
    one = sorted(tuple(r) for r in count_diff(df, "day", d1, d2).collect())
    two = sorted(tuple(r) for r in count_diff_outer_join(df, "day", d1, d2).collect())
    c1, c2 = Counter(), Counter()
    for day, line in data:
        for tok in line.strip().split(" "):
            if tok.startswith("#"):
                (c1 if day == d1 else c2 if day == d2 else Counter())[tok] += 1
    want = sorted((t, c1[t], c2[t], c2[t] - c1[t]) for t in set(c1) | set(c2))
    assert one == two == want


@SLOW
@given(st.lists(st.one_of(st.none(), st.integers(0, 8)), max_size=40))
def test_segments_equal_python(spark, sizes):
    from cascara.operators import segments as G

    df = spark.createDataFrame(list(enumerate(sizes)), "id int, n int")
    multi = Counter(s for s in sizes if s is not None and s > 1)
    shared = [s for s, c in multi.items() if c > 1]
    cut = max(shared) if shared else 1

    def label(s):
        if s == 1:
            return "single"
        if s is not None and s > cut:
            return "extreme"
        if s is not None and s > 1:
            return "multi"
        return "other"

    got = {r["id"]: r["segment"] for r in G.segment_rows(df, "n").collect()}
    assert got == {i: label(s) for i, s in enumerate(sizes)}
    row = G.non_rare_max(df, "n").first()
    assert (row["max_non_rare"] if row else None) == (max(shared) if shared else None)
