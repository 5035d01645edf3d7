import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from cascara.operators import text as X
from cascara.plans import standins as S
from conftest import SF_MID


def test_token_counts_keep_empty_tokens(spark):
    lines = ["a  b", "", "b a", " c "]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r["token"]: r["count"] for r in X.token_counts(df).collect()}
    want = Counter(t for x in lines for t in x.strip().split(" "))
    assert got == dict(want)


def test_token_counts_sorted_desc_with_key_tiebreak(spark):
    df = spark.createDataFrame([("b a c a b a",)], "value string")
    rows = [(r["token"], r["count"]) for r in X.token_counts(df).collect()]
    assert rows == [("a", 3), ("b", 2), ("c", 1)]


def test_prefix_counts_case_sensitive(spark):
    df = spark.createDataFrame([("#Boston #boston #Boston x",)], "value string")
    got = {r["token"]: r["count"] for r in X.prefix_token_counts(df).collect()}
    assert got == {"#Boston": 2, "#boston": 1}


def test_count_diff_single_scan_equals_outer_join(spark):
    ev = S.tagged_events(spark, SF_MID)
    d1, d2 = S.first_days(spark, SF_MID)
    a = sorted(tuple(r) for r in X.count_diff(ev, "day", d1, d2).collect())
    b = sorted(tuple(r) for r in X.count_diff_outer_join(ev, "day", d1, d2).collect())
    assert a == b and len(a) > 0
    # new tags are positive, vanished tags negative
    assert all(r[3] == r[2] - r[1] for r in a)


def test_count_diff_literal_days_and_new_keys(spark):
    day1, day2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    rows = [(day1, "#a #b #b"), (day2, "#b #c"), (dt.date(2024, 1, 3), "#z")]
    df = spark.createDataFrame(rows, "day date, value string")
    got = {r["token"]: (r["count_day1"], r["count_day2"], r["diff"])
           for r in X.count_diff(df, "day", day1, day2).collect()}
    assert got == {"#a": (1, 0, -1), "#b": (2, 1, -1), "#c": (0, 1, 1)}
    new = [(r["token"], r["count_day2"]) for r in X.new_keys_only(df, "day", day1, day2).collect()]
    assert new == [("#c", 1)]


def test_count_diff_independent_of_session_time_zone(spark):
    import os
    import sys

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    import __spark_entry__ as E
    from oracle_check import compare, duck

    con = duck(SF_MID)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        ok, msg = compare(spark, con, "count_diff", E.queries()["count_diff"],
                          E.oracle_sql()["count_diff"], SF_MID)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert ok, msg


def test_count_diff_on_empty_input(spark):
    df = spark.createDataFrame([], "day date, value string")
    assert X.count_diff(df, "day", None, None).count() == 0
