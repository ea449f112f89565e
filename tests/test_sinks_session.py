"""K5-K8 on files, F6/S5 configuration."""

import os

import pytest
from pyspark.sql import functions as F

from strata.session import object_store_conf, session_conf
from strata.sinks.console import preview
from strata.sinks.files import append_stamped, publish_single_object


def _parts(path):
    return [f for f in os.listdir(path) if f.startswith("part-")]


def test_single_object_is_always_one_part(spark, tmp_path):
    df = spark.range(0, 100, 1, 8)
    publish_single_object(df, str(tmp_path / "one"), fmt="json")
    assert len(_parts(str(tmp_path / "one"))) == 1
    assert spark.read.json(str(tmp_path / "one")).count() == 100


def test_single_object_refuses_its_own_input(spark, tmp_path):
    path = str(tmp_path / "in put")                        # a space, URL-encoded in Spark's file list
    spark.range(0, 100, 1, 4).write.parquet(path)
    with pytest.raises(ValueError, match="reads from it"):
        publish_single_object(spark.read.parquet(path), path, fmt="parquet")
    with pytest.raises(ValueError, match="reads from it"):
        publish_single_object(spark.read.parquet(path), "file://" + path,
                              fmt="parquet")
    assert spark.read.parquet(path).count() == 100


def test_append_stamped_and_create_if_absent(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.sql(f"CREATE TABLE IF NOT EXISTS write_log (note STRING, timestamp TIMESTAMP) "
              f"USING parquet LOCATION '{path}'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS write_log (note STRING, timestamp TIMESTAMP) "
              f"USING parquet LOCATION '{path}'")
    row = spark.createDataFrame([("inserted",)], "note string")
    append_stamped(row, path)
    append_stamped(row, path)
    got = spark.table("write_log").collect()
    assert len(got) == 2 and all(r.timestamp is not None for r in got)
    spark.sql("DROP TABLE write_log")


def test_preview_top_n(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 7)
    got = [r.id for r in preview(df, 3, [F.col("id").desc()]).collect()]
    assert got == [99, 98, 97]


def test_session_profiles():
    local = session_conf("local", with_delta=False)
    assert local["spark.sql.adaptive.enabled"] == "true"
    assert "spark.sql.extensions" not in local
    cluster = session_conf("cluster", with_delta=True)
    assert cluster["spark.sql.extensions"].endswith("DeltaSparkSessionExtension")
    assert int(cluster["spark.sql.shuffle.partitions"]) > 8
    with pytest.raises(ValueError):
        session_conf("nope")


def test_object_store_keys_from_env(monkeypatch):
    monkeypatch.setenv("AWS_ACCESS_KEY_ID", "ak")
    monkeypatch.setenv("AWS_SECRET_ACCESS_KEY", "sk")
    c = object_store_conf("http://store:9000")
    assert c["spark.hadoop.fs.s3a.access.key"] == "ak"
    assert c["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert c["spark.hadoop.fs.s3a.path.style.access"] == "true"


def test_checkpoint_dir_is_set(spark):
    from strata.session import ensure_checkpoint_dir, scratch_path

    d = ensure_checkpoint_dir(spark)
    assert d and scratch_path(spark, "x").startswith(d.rstrip("/"))


def test_apply_object_store_conf(spark):
    from strata.session import apply_object_store_conf

    apply_object_store_conf(spark, {"spark.hadoop.fs.s3a.endpoint": "http://store:9000"})
    assert spark.conf.get("fs.s3a.endpoint") == "http://store:9000"
    spark.conf.unset("fs.s3a.endpoint")


def test_local_frame_empty_and_pandas(spark):
    import pandas as pd

    from strata.functions.schemas import BREWERY_SCHEMA
    from strata.sources.local import local_frame

    assert local_frame(spark, [], BREWERY_SCHEMA).columns == BREWERY_SCHEMA.fieldNames()
    pdf = pd.DataFrame({"name": ["a"], "id": ["1"]})       # columns out of order, some missing
    row = local_frame(spark, pdf, BREWERY_SCHEMA).collect()[0]
    assert row.id == "1" and row.name == "a" and row.city is None


def test_medallion_job_keeps_given_session(spark, tmp_path):
    from strata.plans.medallion import MedallionParams, medallion_job

    p = MedallionParams(root=str(tmp_path / "m"), partition_by=["g"], group_by=["g"])
    res = medallion_job(lambda s: s.range(10).selectExpr("id", "id % 3 AS g"), p, spark=spark)
    assert res.counts == {"bronze": 10, "silver": 10, "gold": 3}
    assert spark.range(1).count() == 1                     # session still alive
    with pytest.raises(Exception):
        medallion_job(lambda s: s.range(3).selectExpr("id"), p, spark=spark)   # no column g
    assert spark.range(1).count() == 1


def test_silver_read_prunes_partitions_and_columns(spark, tmp_path):
    from strata.sinks.files import write_table
    from strata.sources.files import read_table

    df = spark.range(100).selectExpr("id", "CAST(id % 5 AS STRING) AS p", "id * 2 AS v")
    write_table(df, str(tmp_path / "s"), partition_by=["p"], mode="overwrite")
    q = read_table(spark, str(tmp_path / "s"), schema=df.schema).filter("p = '3'").select("v")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan and "(p" in plan and "= 3)" in plan
    assert "ReadSchema: struct<v:bigint>" in plan
    assert q.count() == 20


def test_single_object_named(spark, tmp_path):
    import json

    df = spark.range(5).selectExpr("id", "id * 2 AS v")
    path = str(tmp_path / "gold")
    publish_single_object(df, path, object_name="gold.json")
    assert os.path.isfile(os.path.join(path, "gold.json")) and not _parts(path)
    lines = open(os.path.join(path, "gold.json")).read().splitlines()
    assert sorted(json.loads(x)["v"] for x in lines) == [0, 2, 4, 6, 8]
    assert spark.read.json(path).count() == 5          # the folder still reads as a dataset
