"""A2 on stored layers: how a table's rows lie in its files.

Spark's hidden file columns (``_metadata``) name the file and the block that each row
was read from, so one aggregate with map-side combine counts rows per file or per
read block, without opening files on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def file_layout(stored: DataFrame) -> DataFrame:
    """``file`` (full path), ``bytes`` and ``rows`` of every data file that holds rows.

    ``stored`` is a frame straight from a file reader (partition columns may be there).
    """
    meta = stored.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    return meta.groupBy("file", "bytes").agg(F.count(F.lit(1)).alias("rows"))


def block_layout(stored: DataFrame) -> DataFrame:
    """``file``, ``start`` and ``rows`` of every block that one read task takes."""
    meta = stored.select(F.col("_metadata.file_path").alias("file"),
                         F.col("_metadata.file_block_start").alias("start"))
    return meta.groupBy("file", "start").agg(F.count(F.lit(1)).alias("rows"))


def folder_layout(stored: DataFrame, depth: int = 1) -> DataFrame:
    """``folder`` (the last ``depth`` folder names of a file's path), ``files`` and ``rows``."""
    parts = F.split("file", "/")
    folder = F.array_join(F.slice(parts, F.size(parts) - depth, depth), "/")
    return (file_layout(stored).groupBy(F.url_decode(folder).alias("folder"))
            .agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows")))


def layout_summary(stored: DataFrame) -> DataFrame:
    """One row: files, rows, least, median and most rows of a file, and most to median."""
    files = file_layout(stored)
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.min("rows").alias("least"),
                     F.percentile("rows", 0.5).alias("median"), F.max("rows").alias("most")).withColumn(
        "most_to_median", F.col("most") / F.col("median"))
