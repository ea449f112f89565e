"""Range generator with a fixed partition count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def range_frame(spark: SparkSession, start: int, end: int, step: int = 1,
                num_partitions: int | None = None) -> DataFrame:
    """``id`` values ``start, start+step, ... < end`` split evenly over
    ``num_partitions`` tasks (no shuffle, no input)."""
    return spark.range(start, end, step, num_partitions)
