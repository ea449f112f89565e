"""Position of every row in its group, without a window over the group.

Rows are range-partitioned by (group, order), so that a group holding a third of
all rows spreads over a third of the tasks; each task numbers its sorted rows,
the numbered rows are stored, and one small row per (task, group) carries the
offset of the task's part within the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.blocks import stored

ROWS_PER_TASK = 1 << 20
LOCAL_BITS = 33                  # monotonically_increasing_id(): task << 33 | row of the task


def numbered(df: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """``df`` in stored form with ``_mid``: task and row number under (group, order).

    ``group`` names columns without nulls; ``order`` is total up to rows that
    are alike in every column that matters.
    """
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_PER_TASK))
    by = [*group, *order]
    return stored(df.repartitionByRange(tasks, *by).sortWithinPartitions(*by)
                  .withColumn("_mid", F.monotonically_increasing_id()), name)


def task() -> Column:
    return F.shiftright("_mid", LOCAL_BITS).alias("_task")


def spans(rows: DataFrame, group: list[str]) -> DataFrame:
    """_task, group, ``_first`` (smallest _mid), ``_off`` (rows of the group in
    earlier tasks) and ``_size`` (rows of the group); one row per task and group."""
    part = rows.groupBy(task(), *group).agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_part"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    return part.select("_task", *group, "_first",
                       F.coalesce(F.sum("_part").over(before), F.lit(0)).cast("long").alias("_off"),
                       F.sum("_part").over(whole).cast("long").alias("_size"))


def positions(df: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """``df`` with ``pos`` (0-based) and ``n`` (rows of the group)."""
    rows = numbered(df, group, order, name)
    return (rows.withColumn("_task", task()).join(spans(rows, group), ["_task", *group])
            .select(*df.columns, (F.col("_mid") - F.col("_first") + F.col("_off")).alias("pos"),
                    F.col("_size").alias("n")))
