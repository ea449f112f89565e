"""One test per row of the survey's semantics table (section 2.8)."""

import datetime as dt
import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from strata.functions.schemas import BREWERY_SCHEMA
from strata.operators.aggregates import gold_counts
from strata.operators.cleansing import drop_incomplete
from strata.operators.routing import route_pages
from strata.operators.union import union_by_name
from strata.plans.medallion import MedallionParams, run_medallion
from strata.sinks.files import assert_not_reading, write_json, write_table
from strata.sources.files import read_json, read_table


def _brew(spark, rows):
    return spark.createDataFrame(rows, BREWERY_SCHEMA)


def _rec(i, state="CA", btype="micro", **kw):
    d = {f: f"{f}-{i}" for f in BREWERY_SCHEMA.fieldNames()}
    d.update(id=str(i), state_province=state, brewery_type=btype, longitude="1.5", latitude="2.5")
    d.update(kw)
    return tuple(d[f] for f in BREWERY_SCHEMA.fieldNames())


# 1: a key present on one page only makes every other row incomplete.
def test_stray_key_empties_other_rows(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    b = spark.createDataFrame([(3, "c", "x")], "k long, v string, extra string")
    out = drop_incomplete(union_by_name([a, b])).collect()
    assert [r.k for r in out] == [3]
    # ... and a subset keeps them.
    assert drop_incomplete(union_by_name([a, b]), subset=["v"]).count() == 3


# 2: an error object is not data: routed to a sentinel row.
def test_error_object_routed_to_sentinel(spark):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])
    env = spark.createDataFrame([
        (1, "u1", 200, '[{"id": "a", "name": "A"}, {"id": "b", "name": "B"}]'),
        (2, "u2", 500, '{"message": "boom"}'),
        (3, "u3", 200, "[]"),
        (4, "u4", 200, "not json"),
        (5, "u5", None, None),
        (6, "u6", 200, '{"id": "c", "name": "C"}'),
    ], "page INT, url STRING, status INT, body STRING")
    records, sentinels = route_pages(env, schema)
    assert sorted((r.page, r.position, r.id) for r in records.collect()) == [
        (1, 0, "a"), (1, 1, "b"), (6, 0, "c")]
    assert sorted((r.id, r.name) for r in sentinels.collect()) == [
        ("u2", None), ("u3", None), ("u4", None), ("u5", None)]


# 3: an empty crawl gives empty tables with the declared columns.
def test_empty_crawl_keeps_schema(spark, tmp_path):
    empty = spark.createDataFrame([], BREWERY_SCHEMA)
    p = MedallionParams(root=str(tmp_path / "m"), partition_by=["state_province"],
                        group_by=["state_province", "brewery_type"], schema=BREWERY_SCHEMA)
    res = run_medallion(spark, empty, p)
    assert res.counts == {"bronze": 0, "silver": 0, "gold": 0}
    assert res.gold.columns == ["state_province", "brewery_type", "count"]
    assert res.gold.count() == 0
    assert res.silver.columns == BREWERY_SCHEMA.fieldNames()


# 4: where incomplete rows are dropped is a parameter.
@pytest.mark.parametrize("where,bronze_rows", [("bronze", 1), ("silver", 2), (None, 2)])
def test_drop_incomplete_at(spark, tmp_path, where, bronze_rows):
    rows = [_rec(1), _rec(2, phone=None)]
    p = MedallionParams(root=str(tmp_path / "m"), partition_by=["state_province"],
                        group_by=["state_province", "brewery_type"], schema=BREWERY_SCHEMA,
                        drop_incomplete_at=where)
    res = run_medallion(spark, _brew(spark, rows), p)
    assert res.counts["bronze"] == bronze_rows
    assert res.counts["silver"] == (1 if where else 2)


# 5: empty string is a value; NaN is missing.
def test_empty_string_kept_nan_dropped(spark):
    df = spark.createDataFrame([("", 1.0), ("x", float("nan")), (None, 2.0)], "s string, d double")
    assert [(r.s, r.d) for r in drop_incomplete(df).collect()] == [("", 1.0)]


# 6 + 7: all-null columns survive and types stay declared with our bronze.
def test_bronze_keeps_null_columns_and_types(spark, tmp_path):
    df = spark.createDataFrame([(1, None, 2.5)], "i int, s string, f float")
    write_json(df, str(tmp_path / "b"))
    inferred = read_json(spark, str(tmp_path / "b"))
    assert "s" in inferred.columns                      # written as explicit null
    assert dict(inferred.dtypes)["i"] == "bigint"        # inference widens
    declared = read_json(spark, str(tmp_path / "b"), df.schema)
    assert declared.dtypes == df.dtypes
    assert declared.collect() == df.collect()


# 8: microsecond timestamps survive the JSON round trip.
def test_bronze_timestamps_microseconds(spark, tmp_path):
    ts = dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    df = spark.createDataFrame([(ts, ts)], "a timestamp_ntz, b timestamp")
    write_json(df, str(tmp_path / "b"))
    back = read_json(spark, str(tmp_path / "b"), df.schema).collect()[0]
    assert back.a == ts and back.b.replace(tzinfo=None) == df.collect()[0].b.replace(tzinfo=None)


# 9 + 10: partition values keep their declared type; special characters survive.
def test_partition_values_round_trip(spark, tmp_path):
    vals = ["01", "New York", "a/b", "c:d", "São Paulo", ""]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, sp string")
    write_table(df, str(tmp_path / "s"), partition_by=["sp"], mode="overwrite")
    back = read_table(spark, str(tmp_path / "s"), schema=df.schema).select("i", "sp")
    got = {r.i: r.sp for r in back.collect()}
    assert got[0] == "01"                              # not re-typed to 1
    assert [got[i] for i in range(1, 5)] == vals[1:5]
    assert got[5] is None                              # empty string reads back as null


# 11: create-only fails on a second run; the default policy reruns.
def test_rerun_policy(spark, tmp_path):
    df = _brew(spark, [_rec(1), _rec(2, state="NY")])
    keys = ["state_province", "brewery_type"]
    p = MedallionParams(root=str(tmp_path / "m"), partition_by=["state_province"], group_by=keys,
                        schema=BREWERY_SCHEMA)
    run_medallion(spark, df, p)
    assert run_medallion(spark, df, p).gold.count() == 2
    strict = MedallionParams(root=str(tmp_path / "m"), partition_by=["state_province"],
                             group_by=keys, schema=BREWERY_SCHEMA,
                             silver_mode="errorifexists", gold_mode="errorifexists")
    with pytest.raises(Exception, match="(?i)already exists"):
        run_medallion(spark, df, strict)


# 12: overwriting a folder the DataFrame reads is refused.
def test_overwrite_of_input_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    df = spark.read.parquet(path)
    with pytest.raises(ValueError, match="reads from it"):
        assert_not_reading(df, path)
    with pytest.raises(ValueError):
        write_table(df, path, mode="overwrite")
    assert spark.read.parquet(path).count() == 10


# 13: gold reads silver (columnar, pruned), not bronze.
def test_gold_reads_silver(spark, tmp_path):
    df = _brew(spark, [_rec(i, state=s) for i, s in enumerate(["CA", "CA", "NY"])])
    p = MedallionParams(root=str(tmp_path / "m"), partition_by=["state_province"],
                        group_by=["state_province", "brewery_type"], schema=BREWERY_SCHEMA)
    res = run_medallion(spark, df, p)
    plan = gold_counts(res.silver, p.group_by)._jdf.queryExecution().executedPlan().toString()
    assert "silver" in plan and "bronze" not in plan
    assert "ReadSchema: struct<brewery_type:string>" in plan


# 14: null keys form their own group.
def test_null_group_kept(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "k string")
    got = {r.k: r["count"] for r in gold_counts(df, ["k"]).collect()}
    assert got == {"a": 1, None: 2}


# 15: gold is sorted again on read, ties broken by keys.
def test_gold_order_total(spark, tmp_path):
    rows = [_rec(i, state=s, btype=b) for i, (s, b) in enumerate(
        [("NY", "micro"), ("CA", "brewpub"), ("CA", "micro"), ("NY", "micro"), ("CA", "micro")])]
    p = MedallionParams(root=str(tmp_path / "m"), partition_by=["state_province"],
                        group_by=["state_province", "brewery_type"], schema=BREWERY_SCHEMA)
    got = [tuple(r) for r in run_medallion(spark, _brew(spark, rows), p).gold.collect()]
    assert got == [("CA", "micro", 2), ("NY", "micro", 2), ("CA", "brewpub", 1)]


# 17: arrays are turned into JSON text before a JDBC write.
def test_jdbc_arrays_as_json(spark):
    from strata.sinks.jdbc import _complex_to_json, jdbc_options

    df = spark.createDataFrame([(1, [1.0, 2.0])], "id int, v array<float>")
    assert _complex_to_json(df).dtypes == [("id", "int"), ("v", "string")]
    os.environ["STRATA_TEST_PW"] = "s3cret"
    o = jdbc_options("jdbc:x://h/db", "t", user="u", password_env="STRATA_TEST_PW",
                     truncate=True, num_partitions=4, column_types="note VARCHAR(255)")
    assert o["password"] == "s3cret" and o["truncate"] == "true" and o["numPartitions"] == "4"
    assert o["createTableColumnTypes"] == "note VARCHAR(255)"


# 18: the page range is an option; crawl order walks down.
def test_page_range():
    from strata.sources.paged_json import PagedJsonReader

    def pages(first, last):
        lanes = PagedJsonReader({"url": "u", "first": first, "last": last, "concurrency": 2}).partitions()
        return [p for lane in lanes for p in lane.pages]

    assert pages(40, 37) == [40, 39, 38, 37]
    assert pages(46, 46) == [46]
    assert pages(1, 3) == [1, 2, 3]


def test_coordinates_try_cast(spark):
    from strata.functions.schemas import BREWERY_CASTS
    from strata.plans.medallion import cast_columns

    df = _brew(spark, [_rec(1, longitude="-122.5", latitude="abc")])
    r = cast_columns(df, BREWERY_CASTS).collect()[0]
    assert r.longitude == -122.5 and r.latitude is None


def test_gold_null_key_after_drop_none(spark, tmp_path):
    rows = [_rec(1, btype=None), _rec(2, btype=None), _rec(3)]
    p = MedallionParams(root=str(tmp_path / "m"), partition_by=["state_province"],
                        group_by=["state_province", "brewery_type"], schema=BREWERY_SCHEMA,
                        drop_incomplete_at=None)
    got = {(r.state_province, r.brewery_type): r["count"]
           for r in run_medallion(spark, _brew(spark, rows), p).gold.collect()}
    assert got == {("CA", None): 2, ("CA", "micro"): 1}


def test_observed_counts_match(spark, tmp_path):
    df = _brew(spark, [_rec(i, state=["CA", "NY", "TX"][i % 3]) for i in range(30)])
    p = MedallionParams(root=str(tmp_path / "m"), partition_by=["state_province"],
                        group_by=["state_province", "brewery_type"], schema=BREWERY_SCHEMA)
    res = run_medallion(spark, df, p)
    assert res.counts == {"bronze": 30, "silver": 30, "gold": 3}
    assert res.silver.count() == 30
    assert "_SUCCESS" in os.listdir(p.silver_path)
    assert res.gold.agg(F.sum("count")).first()[0] == 30
    assert Row(state_province="CA", brewery_type="micro", count=10) in res.gold.collect()


def test_register_layers_in_catalog(spark, tmp_path):
    from strata.plans.medallion import register_layers

    df = _brew(spark, [_rec(1), _rec(2, state="NY"), _rec(3)])
    p = MedallionParams(root=str(tmp_path / "m"), partition_by=["state_province"],
                        group_by=["state_province", "brewery_type"], schema=BREWERY_SCHEMA)
    run_medallion(spark, df, p)
    names = register_layers(spark, p, BREWERY_SCHEMA, prefix="brew_")
    assert names == ["brew_bronze", "brew_silver", "brew_gold"]
    assert spark.sql("SELECT count(*) FROM brew_bronze").first()[0] == 3
    assert spark.sql("SELECT count(*) FROM brew_silver WHERE state_province = 'NY'").first()[0] == 1
    assert spark.sql("SELECT sum(count) FROM brew_gold").first()[0] == 3
    register_layers(spark, p, BREWERY_SCHEMA, prefix="brew_")          # idempotent
    for n in names:
        spark.sql(f"DROP TABLE {n}")


def test_missing_format_fails_loud(spark, tmp_path):
    df = spark.range(3).selectExpr("id", "id % 2 AS g")
    with pytest.raises(Exception, match="(?i)avro"):
        write_table(df, str(tmp_path / "a"), fmt="avro", mode="overwrite")


def test_bronze_compression(spark, tmp_path):
    df = _brew(spark, [_rec(i) for i in range(20)])
    p = MedallionParams(root=str(tmp_path / "m"), partition_by=["state_province"],
                        group_by=["state_province", "brewery_type"], schema=BREWERY_SCHEMA,
                        bronze_compression="gzip")
    res = run_medallion(spark, df, p)
    assert res.counts == {"bronze": 20, "silver": 20, "gold": 1}
    assert any(f.endswith(".json.gz") for f in os.listdir(p.bronze_path))


def test_jdbc_writer_reaches_spark_without_a_database(spark):
    # No database is started: a driver class that does not exist makes Spark
    # fail inside its JDBC writer, which shows the call and options get there.
    from strata.sinks.jdbc import append_jdbc_stamped, write_jdbc

    df = spark.createDataFrame([(1, [1.0, 2.0])], "id int, v array<float>")
    for call in (lambda: write_jdbc(df, url="jdbc:none://nowhere/db", table="serving",
                                    driver="org.example.NoSuchDriver", truncate=True),
                 lambda: append_jdbc_stamped(df, url="jdbc:none://nowhere/db", table="log",
                                             driver="org.example.NoSuchDriver")):
        with pytest.raises(Exception, match="NoSuchDriver"):
            call()


def test_partition_value_estimate_warns(spark, tmp_path, caplog):
    import logging

    df = spark.range(200).selectExpr("id", "CAST(id % 50 AS STRING) AS k")
    base = dict(partition_by=["k"], group_by=["k"], max_partition_values=10)
    with caplog.at_level(logging.WARNING, logger="strata.plans.medallion"):
        res = run_medallion(spark, df, MedallionParams(root=str(tmp_path / "w"), **base))
    assert res.counts["silver"] == 200
    assert any("partition folders" in r.message for r in caplog.records)


def test_dotted_names_through_the_flow(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (3, "b", float("nan")), (4, None, 4.0), (5, "b", 5.0)],
                               "id long, `geo.state` string, `geo.lat` double")
    res = run_medallion(spark, df, MedallionParams(root=str(tmp_path / "m"), partition_by=["geo.state"],
                                                   group_by=["geo.state"]))
    assert res.counts == {"bronze": 3, "silver": 3, "gold": 2}
    assert [tuple(r) for r in res.gold.collect()] == [("a", 2), ("b", 1)]
