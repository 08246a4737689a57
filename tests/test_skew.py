"""One key holding a third of all rows: results stay exact and the plans
cut the hot key down inside each map task."""

import datetime as dt

from pyspark.sql import functions as F

from engine_helpers import plan_text
from tarmac.operators.dedupe import latest_per_key
from tarmac.session import cluster_settings


def skewed(spark, n=30_000):
    # key 0 holds a third of the rows; the rest spread over 2,000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("k"),
        F.col("id").alias("v"),
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_interval(secs=F.col("id").cast("int"))).alias("ts"),
    ).repartition(8)


def test_latest_per_key_on_hot_key(spark):
    df = skewed(spark)
    out = latest_per_key(df, ["k"], [F.col("ts").desc(), F.col("v").desc()])
    plan = plan_text(out, "simple")
    assert plan.count("WindowGroupLimit") == 2  # map-side limit before the exchange
    got = {r.k: r.v for r in out.collect()}
    expected = {r.k: r.v for r in df.groupBy("k").agg(F.max("v").alias("v")).collect()}  # brute force
    assert got == expected


def test_partial_aggregation_on_hot_key(spark):
    df = skewed(spark)
    agg = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"))
    assert "partial_count" in plan_text(agg, "simple")
    hot = agg.where("k = 0").first()
    assert hot.n == 10_000 and hot.s == sum(range(0, 30_000, 3))


def test_cluster_settings_scale_with_input():
    small = cluster_settings(10 << 30, total_cores=64)
    big = cluster_settings(100 << 40, total_cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert big["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
