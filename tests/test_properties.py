"""Property tests (hypothesis): union counts, gold totals, bronze round trip."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators.aggregates import gold_counts
from strata.operators.union import union_by_name
from strata.sinks.files import write_json
from strata.sources.files import read_json

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.sampled_from(["CA", "NY", "TX", None, ""])
rows = st.lists(st.tuples(keys, st.sampled_from(["micro", "large", None])), max_size=40)


@SETTINGS
@given(parts=st.lists(rows, min_size=1, max_size=4))
def test_union_count_is_sum(spark, parts):
    frames = [spark.createDataFrame(p, "s string, t string") for p in parts]
    assert union_by_name(frames).count() == sum(len(p) for p in parts)


@SETTINGS
@given(data=rows)
def test_gold_total_equals_rows(spark, data):
    df = spark.createDataFrame(data, "s string, t string")
    g = gold_counts(df, ["s", "t"])
    assert (g.agg(F.sum("count")).first()[0] or 0) == len(data)
    counts = [r["count"] for r in g.collect()]
    assert counts == sorted(counts, reverse=True)


@SETTINGS
@given(data=st.lists(st.tuples(st.integers(-2**40, 2**40), st.text(max_size=8) | st.none(),
                               st.floats(allow_nan=False, allow_infinity=False) | st.none()),
                     max_size=30))
def test_bronze_round_trip_lossless(spark, tmp_path_factory, data):
    df = spark.createDataFrame(data, "i bigint, s string, d double")
    path = str(tmp_path_factory.mktemp("b"))
    write_json(df, path + "/x")
    back = read_json(spark, path + "/x", df.schema)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


leaf = st.one_of(st.none(), st.integers(-1000, 1000))


@SETTINGS
@given(data=st.lists(st.tuples(leaf, st.tuples(leaf, st.tuples(leaf, leaf)), leaf), max_size=20))
def test_flatten_then_rebuild(spark, data):
    from strata.functions.flatten import flatten

    schema = "a int, s struct<b:int, t:struct<c:int, d:int>>, e int"
    rows = [(a, None if s is None else (s[0], s[1]), e) for a, s, e in data]
    df = spark.createDataFrame(rows, schema)
    flat = flatten(df)
    assert flat.columns == ["a", "s.b", "s.t.c", "s.t.d", "e"]
    rebuilt = flat.select(
        "a",
        F.struct(F.col("`s.b`").alias("b"),
                 F.struct(F.col("`s.t.c`").alias("c"), F.col("`s.t.d`").alias("d")).alias("t")
                 ).alias("s"),
        "e")
    # a null struct flattens to null leaves; rebuilding gives a struct of nulls
    def norm(r):
        s = r.s
        if s is not None and s.b is None and (s.t is None or (s.t.c is None and s.t.d is None)):
            s = None
        t = None if s is None else (s.b, None if s.t is None or (s.t.c is None and s.t.d is None)
                                    else (s.t.c, s.t.d))
        return (r.a, t, r.e)
    assert sorted(map(norm, rebuilt.collect()), key=repr) == sorted(map(norm, df.collect()), key=repr)


@SETTINGS
@given(pages=st.lists(st.sampled_from([1, 2, 3, 7, 7, 7, 7]), max_size=60),
       parts=st.integers(1, 9))
def test_sequence_is_row_number(spark, pages, parts):
    from pyspark.sql import Window

    from strata.operators.sequence import with_sequence

    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "k long, page long")
    order = [F.col("page").desc(), F.col("k")]
    got = {r.k: r.seq for r in with_sequence(df, order, num_partitions=parts).collect()}
    exp = {r.k: r.rn - 1 for r in df.withColumn("rn", F.row_number().over(Window.orderBy(*order)))
           .collect()}
    assert got == exp


def test_bronze_round_trip_float_arrays(spark, tmp_path):
    from tests.conftest import SF_SMALL

    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    write_json(emb, str(tmp_path / "b"))
    back = read_json(spark, str(tmp_path / "b"), emb.schema)
    assert back.schema == emb.schema
    assert back.exceptAll(emb).count() == 0 and emb.exceptAll(back).count() == 0
