"""Plan-shape guards: what the optimizer must keep doing for the design to
hold at scale."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from cascara.session import watch_materialized
from conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow", "PythonMapInArrow")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_no_cross_join_or_python_in_any_plan(spark, name):
    """The result's plan and those of all tables written on the way (the core
    queries: training-data operators may use Python)."""
    bad = []

    def look(df, part):
        text = plan(df)
        bad.extend((part, f) for f in FORBIDDEN if f in text)

    with watch_materialized(look):
        look(E.QUERIES[name](spark, SF_SMALL), "result")
    assert not bad, f"{name}: {bad}"


def test_counts_use_partial_aggregation(spark):
    for name in ("token_counts", "prefix_token_counts", "item_counts", "tag_counts"):
        text = plan(E.queries()[name](spark, SF_SMALL))
        assert "partial_count" in text, name


def test_count_diff_pushes_day_range_into_scan(spark):
    text = plan(E.queries()["count_diff"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in text


def test_top_rated_filters_before_join_and_prunes_columns(spark):
    text = plan(E.queries()["top_rated"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in text
    # the tag filter is the condition of a filter right on the dimension's scan
    filters = [b for b in text.split("\n\n") if ") Filter" in b and "array_contains(split(p_name" in b]
    assert filters and all("p_name" in b.split("\n")[1] and "l_partkey" not in b for b in filters)
    assert any(") Filter" in b and "rating_count" in b for b in text.split("\n\n"))  # HAVING


def test_day_partitioned_count_diff_prunes_partitions(spark):
    text = plan(E.queries()["count_diff_day_files"](spark, SF_SMALL))
    assert "PartitionFilters: [" in text and " IN (" in text.split("PartitionFilters: [", 1)[1]
