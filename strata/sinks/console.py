"""K8: console preview of the first rows under a total order."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.operators.aggregates import top_n


def preview(df: DataFrame, n: int = 20, order: list | None = None) -> DataFrame:
    """First ``n`` rows; with ``order`` they are the top ``n`` under it."""
    return top_n(df, n, order) if order else df.limit(n)


def show_preview(df: DataFrame, n: int = 20, order: list | None = None) -> None:
    preview(df, n, order).show(n, truncate=False)
