"""Cutting lineage through the shared checkpoint folder.

Used where a result is consumed twice and must be identical both times (ids
assigned in one pass and looked up in another; pages fetched from a remote
API exactly once), and where a recomputation after executor loss would be
expensive.  Data goes to the folder named by ``spark.checkpoint.dir`` (see
``strata.session.ensure_checkpoint_dir``), never to a machine-local one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.session import scratch_path


def cut_lineage(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Write ``df`` once (Parquet, one job) and return a DataFrame that reads the stored copy."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
