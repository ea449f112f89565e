"""Flatten semantics."""

from pyspark.sql import types as T

from strata.functions.flatten import explode_records, flatten, parse_json_column


def test_flatten_nested_keeps_arrays(spark):
    df = spark.createDataFrame(
        [(1, {"a": 1, "b": {"c": "x"}}, [1, 2])],
        "id int, s struct<a:int, b:struct<c:string>>, arr array<int>")
    out = flatten(df)
    assert out.columns == ["id", "s.a", "s.b.c", "arr"]
    assert tuple(out.collect()[0]) == (1, 1, "x", [1, 2])
    assert flatten(df, sep="_").columns == ["id", "s_a", "s_b_c", "arr"]


def test_parse_json_column(spark):
    df = spark.createDataFrame([(1, '{"k": 5, "m": {"n": "z"}}'), (2, "bad")], "id int, props string")
    out = parse_json_column(df, "props", "k BIGINT, m STRUCT<n: STRING>", sep="_", keep=["id"])
    assert out.columns == ["id", "props_k", "props_m_n"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, 5, "z"), (2, None, None)]


def test_explode_lone_object_and_empty(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StructType(
        [T.StructField("c", T.StringType())]))])
    df = spark.createDataFrame([(1, '[{"a": 1, "b": {"c": "x"}}, {"a": 2}]'), (2, '{"a": 3}'),
                                (3, "[]"), (4, None)], "page int, body string")
    out = explode_records(df, "body", schema, keep=["page"], position="pos")
    assert out.columns == ["page", "pos", "a", "b.c"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 0, 1, "x"), (1, 1, 2, None),
                                                       (2, 0, 3, None)]


def test_explode_rescues_unknown_keys(spark):
    import json

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    df = spark.createDataFrame([
        (1, '[{"a": 1, "b": "x"}, {"a": 2, "b": "y", "extra": 5, "geo": {"lat": 1.5}}]'),
        (2, '{"a": 3, "new": "z"}'),
        (3, "[]"),
    ], "page int, body string")
    out = explode_records(df, "body", schema, keep=["page"], position="pos", rescue_col="_rescued")
    assert out.columns == ["page", "pos", "a", "b", "_rescued"]
    rows = {(r.page, r.pos): r for r in out.collect()}
    assert len(rows) == 3
    assert rows[(1, 0)]._rescued is None and rows[(1, 0)].b == "x"
    assert json.loads(rows[(1, 1)]._rescued) == {"extra": "5", "geo": '{"lat":1.5}'}
    assert rows[(2, 0)].a == 3 and json.loads(rows[(2, 0)]._rescued) == {"new": "z"}
