from cascara.operators.text import prefix_token_counts
from cascara.session import scratch_path
from cascara.streaming import prefix_counts_stream, run_available


def test_stream_resumes_from_checkpoint_without_double_counting(spark):
    src = scratch_path(spark, "stream-src")
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    day1 = ["#a #b", "#b x"]
    day2 = ["#b #c #c", "#a"]
    spark.createDataFrame([(x,) for x in day1], "value string").coalesce(1).write.text(f"{src}/d1")

    def run():
        lines = spark.readStream.schema("value string").text(f"{src}/*")
        return {r["token"]: r["count"] for r in
                run_available(prefix_counts_stream(lines), "t", out, ckpt).collect()}

    assert run() == {"#a": 1, "#b": 2}
    spark.createDataFrame([(x,) for x in day2], "value string").coalesce(1).write.text(f"{src}/d2")
    resumed = run()
    batch = spark.createDataFrame([(x,) for x in day1 + day2], "value string")
    assert resumed == {r["token"]: r["count"] for r in prefix_token_counts(batch).collect()}
    assert resumed == {"#a": 2, "#b": 3, "#c": 2}
