"""Union pages by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(frames: list[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Union all (duplicates kept), matching columns by name.

    Columns missing from a frame are filled with null.  Spark folds the chain
    into one ``Union`` node, so a long list does not build a deep plan.
    """
    if not frames:
        raise ValueError("union_by_name needs at least one DataFrame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
