"""Global sequence vs a brute-force row_number on small fixtures, with skew."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.sequence import with_sequence


def test_sequence_matches_row_number_with_hot_page(spark):
    # a third of all rows on one page
    rows = [(i, 7 if i % 3 == 0 else i // 50) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, page long")
    order = [F.col("page").desc(), F.col("k")]
    got = {r.k: r.seq for r in with_sequence(df, order, num_partitions=8).collect()}
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy(*order)) - 1)
    exp = {r.k: r.rn for r in ref.collect()}
    assert got == exp
    assert sorted(got.values()) == list(range(3000))


def test_sequence_empty_and_single(spark):
    empty = spark.createDataFrame([], "k long")
    assert with_sequence(empty, [F.col("k")]).count() == 0
    one = spark.createDataFrame([(5,)], "k long")
    assert [tuple(r) for r in with_sequence(one, [F.col("k")]).collect()] == [(5, 0)]


def test_partition_counts_reference_case(spark):
    from strata.operators.aggregates import partition_counts
    from strata.sources.generators import range_frame

    got = sorted(tuple(r) for r in partition_counts(range_frame(spark, 0, 10000, 1, 4)).collect())
    assert got == [(0, 2500), (1, 2500), (2, 2500), (3, 2500)]
