from pyspark.sql import functions as F

from cascara.llm.mixing import source_targets
from test_native import brute_targets


def test_sources_are_not_gathered_in_one_task(spark):
    sizes = {f"s{k:03}": (k * k) % 997 + (5000 if k % 40 == 0 else 0) for k in range(300)} | {None: 17, "zero": 0}
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(8)
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    was = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        out = source_targets(table, (5, 2, 1), 3).withColumn("task", F.spark_partition_id()).collect()
        assert source_targets(table.limit(0), (5, 2, 1), 3).count() == 0
    finally:
        spark.conf.set(conf, was)
    assert len({r["task"] for r in out}) > 1
    want = brute_targets(sizes)
    assert len(out) == len(sizes)
    for r in out:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) <= 1e-9 * max(1, want[r["source"]])
