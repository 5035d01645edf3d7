import pytest
from pyspark.sql import types as T

from cascara.session import scratch_path
from cascara.sources import PROFILE_SCHEMA, read_csv, read_fields, read_text_lines, write_csv, write_text


def test_text_sink_refuses_existing_path(spark):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    path = scratch_path(spark, "t")
    write_text(df, path)
    assert [r["value"] for r in read_text_lines(spark, path).collect()] == ["a\t1"]
    with pytest.raises(Exception):
        write_text(df, path)


def test_text_sink_is_lossless(spark):
    rows = [("a\tb", 1), ("x\ny\r", 2), ("\\t\\N", 3), ("\\", None), (None, 4), ("", 5), ("\\s\\n", 6)]
    path = scratch_path(spark, "t")
    write_text(spark.createDataFrame(rows, "k string, n int"), path)
    back = read_fields(spark, path, "k string, n int").collect()
    assert sorted(map(tuple, back), key=str) == sorted(rows, key=str)


def test_scratch_scope_removes_what_it_made(spark):
    import os

    from cascara.session import materialize, scratch_scope

    with scratch_scope(spark):
        path = scratch_path(spark, "kept-until-the-end")
        spark.range(3).write.parquet(path)
        assert materialize(spark.range(2), "more").count() == 2 and os.path.exists(path)
        folder = os.path.dirname(path)
        inside = set(os.listdir(folder))
    left = set(os.listdir(folder))
    assert os.path.basename(path) not in left and len(inside - left) == 2


def test_csv_declared_schema_nullable_and_decimals(spark, tmp_path):
    p = tmp_path / "profile.csv"
    header = ",".join(PROFILE_SCHEMA.fieldNames())
    row = ["0", "7", "2", "12.56", "1", "2", "3", "1.5", "1", "2", "3", "4", "true", "", "false",
           "US", "t", "80-23", "h", "s"]
    bad = list(row)
    bad[1] = "notanint"
    p.write_text(header + "\n" + ",".join(row) + "\n" + ",".join(bad) + "\n")
    df = read_csv(spark, str(p), schema=PROFILE_SCHEMA, header=True)
    rows = df.collect()
    assert float(rows[0]["lifetime"]) == 12.56
    assert rows[0]["zmap"] is None and rows[0]["ports_scanned_str"] == "80-23"
    assert rows[1]["id"] is None  # unparsable int becomes NULL


def test_csv_roundtrip_header_and_infer(spark):
    df = spark.createDataFrame([(1, "x,y", 2.5)], "a int, b string, c double")
    path = scratch_path(spark, "csv")
    write_csv(df, path, header=True)
    back = read_csv(spark, path, header=True, infer=True)
    assert dict(back.dtypes) == {"a": "int", "b": "string", "c": "double"}
    assert [tuple(r) for r in back.collect()] == [(1, "x,y", 2.5)]


def test_day_files_with_source_path_feed_count_diff(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from cascara.operators.text import count_diff

    base = scratch_path(spark, "days")
    for day, lines in (("2024-01-01", ["#a #b", "#b x"]), ("2024-01-02", ["#b #c #c"])):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
            .write.text(f"{base}/day={day}-file")
    df = read_text_lines(spark, [f"{base}/day=2024-01-01-file", f"{base}/day=2024-01-02-file"],
                         source_col="src")
    df = df.withColumn("day", F.to_date(F.regexp_extract("src", r"day=(\d{4}-\d{2}-\d{2})", 1)))
    got = {r["token"]: (r["count_day1"], r["count_day2"], r["diff"]) for r in
           count_diff(df, "day", dt.date(2024, 1, 1), dt.date(2024, 1, 2)).collect()}
    assert got == {"#a": (1, 0, -1), "#b": (2, 1, -1), "#c": (0, 2, 2)}


def test_job_runner_writes_whole_result(spark):
    from cascara.run import main
    from conftest import SF_SMALL

    out = scratch_path(spark, "run")
    assert main(["tag_counts", SF_SMALL, out, "--format", "csv"]) == 0
    back = spark.read.option("header", True).option("inferSchema", True).csv(out)
    import __spark_entry__ as E
    want = sorted(tuple(r) for r in E.queries()["tag_counts"](spark, SF_SMALL).collect())
    assert sorted(tuple(r) for r in back.collect()) == want
    with pytest.raises(Exception):
        main(["tag_counts", SF_SMALL, out, "--format", "csv"])


def test_cluster_requires_shared_checkpoint_dir():
    import cascara.session as S

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value if key == S.CHECKPOINT_CONF else default

    class Context:
        master = "yarn"
        applicationId = "app-1"

    class Session:
        def __init__(self, value):
            self.conf = Conf(value)
            self.sparkContext = Context()

    with pytest.raises(RuntimeError):
        S.scratch_path(Session(None), "x")
    assert S.scratch_path(Session("/shared/folder/"), "x").startswith("/shared/folder/scratch/x-")
