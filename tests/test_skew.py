"""Hot keys: a third of all rows on one value must not land in one task."""

import os

from pyspark.sql import functions as F

from strata.operators.aggregates import gold_counts
from strata.sinks.files import write_table


def test_hot_partition_value_split_across_writers(spark, tmp_path):
    n = 60_000
    df = (spark.range(0, n, 1, 8)
          .withColumn("state", F.when(F.col("id") % 3 == 0, F.lit("HOT"))
                      .otherwise(F.concat(F.lit("s"), (F.col("id") % 50).cast("string"))))
          # hash text: does not compress away in the shuffle
          .withColumn("pad", F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 256)
                                        for i in range(4)])))
    # As on a cluster: many more shuffle partitions than partition values, and
    # an advisory size well below the hot value's volume.
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        write_table(df, str(tmp_path / "silver"), partition_by=["state"], mode="overwrite")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    hot = [f for f in os.listdir(tmp_path / "silver" / "state=HOT") if f.startswith("part-")]
    assert len(hot) > 1                                   # split across several tasks
    cold = [f for f in os.listdir(tmp_path / "silver" / "state=s1") if f.startswith("part-")]
    assert len(cold) <= 2                                 # small values are not scattered
    back = spark.read.parquet(str(tmp_path / "silver"))
    assert back.filter("state = 'HOT'").count() == n // 3
    assert back.count() == n


def test_hot_group_counted_map_side(spark):
    df = spark.range(0, 90_000, 1, 8).withColumn(
        "k", F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 100).cast("string")))
    g = gold_counts(df, ["k"])
    plan = g._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan                        # pre-aggregated before the shuffle
    assert g.first()["k"] == "HOT" and g.first()["count"] == 30_000


def test_rebalance_evenly_keys_and_plan(spark):
    from strata.sinks.files import rebalance_evenly

    df = spark.createDataFrame([(1, "a", {"k": 1}, [1.0])], "i int, s string, m map<string,int>, v array<float>")
    plan = rebalance_evenly(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan and "m#" not in plan.split("RebalancePartitions")[1].split("\n")[0]
    only_map = spark.createDataFrame([({"k": 1},)], "m map<string,int>")
    assert rebalance_evenly(only_map).count() == 1          # falls back to round-robin
    big = spark.range(0, 40_000, 1, 1).selectExpr("id", "id % 3 AS g")
    parts = rebalance_evenly(big).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == 40_000
