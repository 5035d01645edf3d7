from pyspark.sql import functions as F

from cascara.operators import features as E
from cascara.operators import segments as G


def _rows(spark, sizes):
    return spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "id int, n int")


def test_cutoff_and_segments(spark):
    # sizes 2 and 3 are shared, 5 and 9 are not -> cut-off 3
    df = _rows(spark, [1, 1, 2, 2, 3, 3, 3, 5, 9, 0])
    assert G.non_rare_max(df, "n").first()["max_non_rare"] == 3
    seg = {r["id"]: r["segment"] for r in G.segment_rows(df, "n").collect()}
    assert [seg[i] for i in range(10)] == ["single", "single", "multi", "multi", "multi", "multi",
                                           "multi", "extreme", "extreme", "other"]
    assert sorted(r["id"] for r in G.extreme_rows(df, "n").collect()) == [7, 8]
    assert sorted(r["id"] for r in G.non_extreme_multi(df, "n").collect()) == [2, 3, 4, 5, 6]
    by = [(r["size"], r["count"]) for r in G.rows_by_set_size(df, "n").collect()]
    assert by == [(3, 3), (2, 2), (5, 1), (9, 1)]


def test_no_shared_size_makes_all_multi_extreme(spark):
    df = _rows(spark, [1, 2, 3])
    assert G.non_rare_max(df, "n").first()["max_non_rare"] is None
    assert sorted(r["id"] for r in G.extreme_rows(df, "n").collect()) == [1, 2]


def test_one_hot_true_counts_equal_item_counts(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a"],), (["b", "c"],), (["a", "c", "d"],)],
                               "items array<string>")
    names = E.top_k_names(df, "items", 3)
    assert names == ["a", "b", "c"]
    oh = E.one_hot_items(df, "items", names, "Port")
    assert oh.columns[-3:] == ["Porta", "Portb", "Portc"]
    chk = E.one_hot_check(oh, df, "items", names, "Port").collect()
    assert all(r["true_count"] == r["item_count"] for r in chk)
    vec = E.assemble(oh, ["Porta", "Portb", "Portc"]).first()["features"]
    assert list(vec.toArray()) == [1.0, 1.0, 0.0]


def test_stored_size_and_array_length_agree_on_stand_in(spark):
    from conftest import SF_SMALL
    from cascara.plans.q_segments import profiles

    prof = profiles(spark, SF_SMALL)
    a = sorted(tuple(r) for r in G.segment_rows(prof, "numports").select("id", "segment").collect())
    b = sorted(tuple(r) for r in G.segment_rows(prof, F.size("items")).select("id", "segment").collect())
    assert a == b and len(a) > 0


def test_sparse_one_hot_equals_wide_columns(spark):
    df = spark.createDataFrame([(["a", "b", "a"],), (["c"],), ([],), (["d", "b"],), (None,)],
                               "items array<string>")
    names = ["b", "a", "c"]
    wide = E.assemble(E.one_hot_items(df, "items", names, "p_"), [f"p_{n}" for n in names], "w")
    both = E.one_hot_vector(wide, "items", names, "v").collect()
    assert all(list(r["w"].toArray()) == list(r["v"].toArray()) for r in both)


def test_one_hot_looks_through_a_row_once(spark):
    df = spark.createDataFrame([(["a", "b", None],), (["a", "z"],), ([],), (None,), ([None],)], "items array<string>")
    oh = E.one_hot_items(df, "items", ["a", None, "b", "c"], "p_", name_by="rank")
    assert oh.columns == ["items", "p_1", "p_2", "p_3", "p_4"]
    assert [tuple(r)[1:] for r in oh.collect()] == [
        (True, None, True, False), (True, None, False, False)] + [(False, None, False, False)] * 3
    names = ["a", "b", "c"]
    chk = E.one_hot_check(E.one_hot_items(df, "items", names, "p_"), df, "items", names, "p_")
    assert sorted(tuple(r) for r in chk.collect()) == [(1, "a", 2, 2), (2, "b", 1, 1), (3, "c", 0, 0)]
    # A column looks among the row's named items, not through the whole row.
    plan = chk._jdf.queryExecution().optimizedPlan().toString()
    assert "array_contains(_hot" in plan and "array_contains(items" not in plan
