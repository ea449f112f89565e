"""Global, gap-free row sequence under a total order (crawl order, U1).

``row_number()`` over a window with no partition runs in a single task, which
does not survive a large input.  Here the order is range-partitioned (the
order columns themselves are the range key, so one hot value is still split
across tasks), each task numbers its rows locally, the rows are materialised
once, and a table of per-task offsets -- one row per task, so its size is
bounded by the partition count -- is broadcast back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.plans.lineage import cut_lineage

_LOCAL_BITS = 33  # monotonically_increasing_id(): partition id << 33 | row index


def with_sequence(df: DataFrame, order: list[Column], seq_col: str = "seq",
                  num_partitions: int | None = None,
                  rows_per_partition: int | None = None) -> DataFrame:
    """Add ``seq_col`` = 0-based position of each row under ``order``.

    ``order`` should be total (end with a unique key); ties are numbered in an
    arbitrary but fixed order.

    The range partitions feed a sort and cannot be split by adaptive
    execution, so their number must follow the data: pass ``num_partitions``,
    or ``rows_per_partition`` to raise it by a row count (one extra,
    column-free job).  The default, ``spark.sql.shuffle.partitions``, suits
    inputs up to that many times a few million rows.
    """
    spark = df.sparkSession
    if num_partitions:
        n = num_partitions
    else:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        if rows_per_partition:
            n = max(n, -(-df.count() // int(rows_per_partition)))
    tagged = (df.repartitionByRange(n, *order)
                .sortWithinPartitions(*order)
                .withColumn("__mid", F.monotonically_increasing_id()))
    tagged = cut_lineage(tagged, "sequence")
    pid = F.shiftright(F.col("__mid"), _LOCAL_BITS)
    per_task = tagged.groupBy(pid.alias("__pid")).agg(F.count(F.lit(1)).alias("__n"))
    offsets = per_task.select(
        "__pid",
        F.coalesce(
            F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("__off"),
    )
    local = F.col("__mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    out = (tagged.join(F.broadcast(offsets), pid == F.col("__pid"))
                 .withColumn(seq_col, (F.col("__off") + local).cast("bigint")))
    return out.drop("__mid", "__pid", "__off")
