"""Every query with an oracle agrees with DuckDB on the sf0.001 tables, and
the entry point runs."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare, duck  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["item_id", "avg_rating", "rating_count", "title"]
    assert df.count() >= 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
