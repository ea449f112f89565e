"""Incremental flow: a second run processes only newly landed files."""

from pyspark.sql import functions as F

from strata.operators.aggregates import gold_counts
from strata.plans.medallion import MedallionParams
from strata.streaming.incremental import run_incremental_medallion
from tests.conftest import SF_SMALL


def test_incremental_runs_accumulate(spark, tmp_path):
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    landing = str(tmp_path / "landing")
    c.filter(F.col("c_custkey") % 2 == 0).write.parquet(landing + "/batch=1")
    keys = ["c_nationkey", "c_mktsegment"]
    p = MedallionParams(root=str(tmp_path / "m"), partition_by=["c_mktsegment"], group_by=keys,
                        schema=c.schema)
    ck = str(tmp_path / "ck")
    r1 = run_incremental_medallion(spark, landing + "/*", "parquet", p, checkpoint_root=ck)
    half = c.filter(F.col("c_custkey") % 2 == 0).count()
    assert r1.bronze_rows == half and r1.silver_rows == half
    assert sorted(map(tuple, r1.gold.collect())) == sorted(
        map(tuple, gold_counts(c.filter(F.col("c_custkey") % 2 == 0), keys).collect()))

    c.filter(F.col("c_custkey") % 2 == 1).write.parquet(landing + "/batch=2")
    r2 = run_incremental_medallion(spark, landing + "/*", "parquet", p, checkpoint_root=ck)
    assert r2.bronze_rows == c.count() - half            # only the new files
    assert sorted(map(tuple, r2.gold.collect())) == sorted(map(tuple, gold_counts(c, keys).collect()))
    got = [r["count"] for r in r2.gold.collect()]
    assert got == sorted(got, reverse=True)


def test_incremental_drop_at_silver_keeps_bronze_raw(spark, tmp_path):
    landing = str(tmp_path / "landing")
    df = spark.createDataFrame([(1, "CA", "micro"), (2, "CA", None), (3, "NY", "large")],
                               "id long, state string, kind string")
    df.write.parquet(landing + "/batch=1")
    p = MedallionParams(root=str(tmp_path / "m"), partition_by=["state"], group_by=["state", "kind"],
                        schema=df.schema, drop_incomplete_at="silver")
    r = run_incremental_medallion(spark, landing + "/*", "parquet", p,
                                  checkpoint_root=str(tmp_path / "ck"))
    assert r.bronze_rows == 3 and r.silver_rows == 2        # rows stored, not rows read
    assert spark.read.json(p.bronze_path).count() == 3      # bronze keeps the incomplete row
    assert sorted(tuple(x) for x in r.gold.collect()) == [("CA", "micro", 1), ("NY", "large", 1)]


def test_every_batch_is_counted(spark, tmp_path):
    landing = str(tmp_path / "landing")
    df = spark.range(240).selectExpr("id", "CAST(id % 3 AS STRING) AS k")
    df.repartition(6).write.parquet(landing)
    p = MedallionParams(root=str(tmp_path / "m"), partition_by=["k"], group_by=["k"], schema=df.schema)
    name = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(name, "2")
    try:
        r = run_incremental_medallion(spark, landing, "parquet", p, checkpoint_root=str(tmp_path / "ck"),
                                      max_files_per_trigger=1)
        assert spark.conf.get(name) == "2"
    finally:
        spark.conf.unset(name)
    assert r.bronze_rows == 240 and r.silver_rows == 240


def test_a_run_over_an_empty_landing_folder_gives_an_empty_gold(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    df = spark.createDataFrame([(1, "a"), (2, ""), (3, None)], "id long, g string")
    p = MedallionParams(root=str(tmp_path / "m"), partition_by=["g"], group_by=["g"], schema=df.schema,
                        drop_incomplete_at=None)
    ck = str(tmp_path / "ck")
    r = run_incremental_medallion(spark, str(landing), "parquet", p, checkpoint_root=ck)
    assert (r.bronze_rows, r.silver_rows, r.gold.collect()) == (0, 0, [])
    df.coalesce(1).write.mode("append").parquet(str(landing))
    r = run_incremental_medallion(spark, str(landing), "parquet", p, checkpoint_root=ck)
    assert (r.bronze_rows, r.silver_rows) == (3, 3)
    assert {(x.g, x["count"]) for x in r.gold.collect()} == {("a", 1), ("", 1), (None, 1)}
