import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cascara.operators import tables as T
from cascara.session import scratch_path
from cascara.sources import column_types, infer_schema, order_faults, read_csv, written_rows

P = (0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0)


def quantiles(df, cols, **options):
    return {(r["column"], r["probability"]): r["value"] for r in T.exact_quantiles(df, cols, P, **options).collect()}


@pytest.mark.parametrize("options", [{}, {"accuracy": 20, "few": 5}, {"accuracy": 4, "few": 1}])
def test_quantiles_equal_duckdb(spark, options):
    rng = np.random.default_rng(1)
    n = 3000
    table = {"u": rng.uniform(-5, 5, n), "heavy": np.where(rng.random(n) < 0.6, 7.0, rng.integers(0, 50, n)),
             "skew": np.exp(rng.normal(0, 4, n)), "one": np.full(n, 3.0), "two": rng.integers(0, 2, n).astype(float)}
    import pandas as pd

    frame = pd.DataFrame(table)
    df = spark.createDataFrame(frame).repartition(5)
    got = quantiles(df, list(table), **options)
    for c in table:
        for p in P:
            assert got[c, p] == duckdb.sql(f"SELECT quantile_disc({c}, {p}) FROM frame").fetchall()[0][0], (c, p)


def test_quantiles_of_nulls_nan_and_nothing(spark):
    df = spark.createDataFrame([(1.0, None, 1), (None, None, 2), (float("nan"), None, 3), (0.5, None, 4)],
                               "a double, b double, c int")
    got = quantiles(df, ["a", "b", "c"])
    assert got["a", 0.25] == 0.5 and got["a", 0.5] == 1.0 and math.isnan(got["a", 1.0])
    assert all(got["b", p] is None for p in P) and got["c", 0.5] == 2.0
    assert all(v is None for v in quantiles(df.where("false"), ["a", "c"]).values())
    full = {r["column"]: r for r in T.describe_quartiles(df, ["c"]).collect()}
    assert (full["c"]["q25"], full["c"]["q50"], full["c"]["q75"], full["c"]["count"]) == (1.0, 2.0, 3.0, 4)


def test_type_lattice(spark):
    rows = [("1", "2147483648", "1.5", "true", "2020-01-31", "2020-01-31 10:00:00", "x", None, "1"),
            ("-2", "1", "2", "False", "1999-12-31", "2020-01-31T10:00:00.5", "1", "", "true"),
            (None, "3", "1e3", "", "2000-02-29", "2021-01-31 10:00:00Z", "", None, "2020-01-01")]
    raw = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(9)))
    got = {r["column"]: r for r in column_types(raw).collect()}
    assert [got[f"c{i}"]["type"] for i in range(9)] == [
        "int", "bigint", "double", "boolean", "date", "timestamp", "string", "string", "string"]
    assert [round(got[f"c{i}"]["null_share"], 3) for i in (0, 1, 3, 6, 7)] == [0.333, 0.0, 0.333, 0.333, 1.0]
    assert [got[f"c{i}"]["misfit"] for i in (0, 1, 2, 6, 7, 8)] == [None, "2147483648", "1.5", "x", None, "2020-01-01"]
    worse = raw.withColumn("c0", F.concat("c0", F.lit("a"))).withColumn("c4", F.lit("2020-02-30"))
    kinds = {r["column"]: (r["type"], r["rows"]) for r in column_types(worse).collect()}
    assert kinds["c0"] == ("string", 3) and kinds["c4"] == ("string", 3)
    assert {r["type"] for r in column_types(raw.where("false")).collect()} == {"string"}


def test_inferred_schema_reads_the_files(spark):
    path = scratch_path(spark, "typed")
    spark.createDataFrame([(1, "a", 2.5, True), (2, None, 3.0, None)], "i int, s string, d double, b boolean").repartition(
        2).write.option("header", True).csv(path)
    schema = infer_schema(spark, path, header=True)
    assert [f.dataType.simpleString() for f in schema] == ["int", "string", "double", "boolean"]
    assert sorted(map(tuple, read_csv(spark, path, schema, header=True).collect()))[1] == (2, None, 3.0, None)


@pytest.mark.parametrize("kind", ["parquet", "csv", "json"])
def test_order_of_written_files(spark, kind):
    df = spark.range(2000).select((F.col("id") % 40).alias("n"), F.when(F.col("id") % 9 > 0, F.md5(F.col("id").cast(
        "string"))).alias("s")).repartition(6)
    keys = [("n", True), ("s", False)]

    def faults(frame):
        path = scratch_path(spark, "order")
        frame.write.format(kind).save(path)
        return order_faults(written_rows(spark, path, kind, "n bigint, s string"), keys).first()

    good = faults(df.repartitionByRange(4, F.desc("n"), F.asc("s")).sortWithinPartitions(F.desc("n"), F.asc("s")))
    assert good["rows"] == 2000 and good["files"] > 1 and good["inversions"] == 0
    assert faults(df)["inversions"] > 500
    # Sorted inside the files only, and files in the wrong order.
    assert faults(df.sortWithinPartitions(F.desc("n"), F.asc("s")))["inversions"] == 5
    assert faults(df.orderBy(F.asc("n"), F.asc("s")))["inversions"] > 30
    one = df.coalesce(1).orderBy(F.desc("n"), F.desc("s"))
    assert faults(one)["inversions"] > 1000


def test_order_of_nothing(spark):
    path = scratch_path(spark, "order")
    spark.range(0).write.parquet(path)
    got = order_faults(written_rows(spark, path, "parquet", "id bigint"), [("id", False)]).first()
    assert tuple(got) == (0, 0, 0)
