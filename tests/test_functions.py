from pyspark.sql import functions as F

from cascara.functions import contains_all, item_label, null_to_zero, ratio, split_on, strip_split


def _tokens(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return [r[0] for r in df.select(strip_split("value")).collect()]


def test_strip_split_matches_python(spark):
    lines = ["  a  b ", "", "\t#x #y\tz\r", "#Boston #boston", " a b　", "\x1ca\x1f",
             "one", " ", "a ", "x​y"]
    assert _tokens(spark, lines) == [x.strip().split(" ") for x in lines]


def test_split_on_literal_delimiters(spark):
    df = spark.createDataFrame([("a|b||c", "1-2-3"), (None, "")], "g string, p string")
    rows = df.select(split_on("g", "|").alias("g"), split_on("p", "-").alias("p")).collect()
    assert rows[0]["g"] == ["a", "b", "", "c"] and rows[0]["p"] == ["1", "2", "3"]
    assert rows[1]["g"] is None and rows[1]["p"] == [""]


def test_contains_all_label_null_ratio(spark):
    df = spark.createDataFrame([(["80", "23", "443"], None, 4, 0)], "a array<string>, n int, x int, z int")
    r = df.select(
        contains_all("a", ["80", "23"]).alias("both"),
        contains_all("a", ["80", "22"]).alias("not_both"),
        item_label(F.lit("80"), F.lit("23")).alias("label"),
        null_to_zero("n").alias("zero"),
        ratio("x", "z").alias("div0"),
        ratio("x", F.lit(2)).alias("half"),
    ).first()
    assert r["both"] and not r["not_both"]
    assert r["label"] == "80-23" and r["zero"] == 0
    assert r["div0"] is None and r["half"] == 2.0
