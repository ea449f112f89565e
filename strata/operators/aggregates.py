"""A1, A2, O1, O2: grouped counts, partition counts, ordering and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.names import quoted

COUNT = "count"


def group_count(df: DataFrame, keys: list[str], count_col: str = COUNT) -> DataFrame:
    """A1: rows per key combination (null keys form their own group).

    Planned as partial hash aggregate -> hash exchange on the keys -> final
    aggregate, so a hot key is pre-counted inside every map task and the
    shuffle carries one row per (task, key) rather than the raw rows.
    """
    return df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias(count_col))


def order_by_count(df: DataFrame, keys: list[str], count_col: str = COUNT) -> DataFrame:
    """O1: count descending; keys ascending break ties so the order is total."""
    return df.orderBy(F.col(quoted(count_col)).desc(), *[F.col(quoted(k)).asc_nulls_first() for k in keys])


def gold_counts(df: DataFrame, keys: list[str], count_col: str = COUNT) -> DataFrame:
    """A1 + O1: the gold table."""
    return order_by_count(group_count(df, keys, count_col), keys, count_col)


def top_n(df: DataFrame, n: int, order: list) -> DataFrame:
    """O2: the first ``n`` rows under a total order (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def partition_counts(df: DataFrame, partition_col: str = "partition",
                     count_col: str = COUNT) -> DataFrame:
    """A2 (with P2): rows per physical partition of ``df``.

    The partition id is tagged before any shuffle, so this measures the input
    layout (skew check); the count itself is a partial + final aggregate.
    """
    return (df.withColumn(partition_col, F.spark_partition_id())
              .groupBy(partition_col)
              .agg(F.count(F.lit(1)).alias(count_col)))
