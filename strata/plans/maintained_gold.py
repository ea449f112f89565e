"""Gold kept up to date by signed group counts, one batch at a time.

A batch replaces whole silver partitions (the partition values that its rows
have).  What it changes in gold is known from those partitions alone: the
counts of the rows it overwrites are taken off, the counts of its own rows are
added.  The history is not counted again, and silver is scanned with a filter on
the landed partition values only.

``apply`` runs in steps that can be repeated.  (1) The batch's rows and its signed
counts are stored under its name; this is the only step that looks at the old
silver.  (2) The silver partitions are replaced from the stored rows.  (3) A new gold
version, the old one plus the signed counts, is written.  (4) The batch is
entered as applied by that version.  (5) The pointer is swapped to the version.
A run cut short at any point is taken up with the stored rows and counts; a batch
is applied once the pointer has reached its version, and then only answers
False.  While a batch is unfinished, no other one is let in.

Null partition and group values are values like any others.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.names import quoted
from strata.operators.aggregates import COUNT, group_count, order_by_count
from strata.sinks.files import write_table
from strata.sinks.partition_codec import decoded, encoded
from strata.sinks.store import Store
from strata.sources.files import read_table


def landed_filter(values: DataFrame, columns: list[str]) -> Column:
    """Rows of the partitions in ``values`` (distinct values of ``columns``).

    The values are those a batch writes folders for, so they are as many as the
    batch's folders.  The first column is an ``IN`` list, which prunes folders.
    """
    rows = values.collect()
    first = [r[0] for r in rows]
    known = sorted({v for v in first if v is not None}, key=str)
    lead = F.col(quoted(columns[0]))
    out = lead.isin(known) if known else F.lit(False)
    if None in first:
        out = out | lead.isNull()
    if len(columns) > 1:
        exact = [reduce(and_, [F.col(quoted(c)).eqNullSafe(F.lit(v)) for c, v in zip(columns, r)]) for r in rows]
        out = out & (reduce(or_, exact) if exact else F.lit(False))
    return out


def signed_counts(old: DataFrame, new: DataFrame, keys: list[str], count_col: str = COUNT) -> DataFrame:
    """Counts of ``new`` less counts of ``old`` by key, without keys that stay equal."""
    off = group_count(old, keys, count_col).withColumn(count_col, -F.col(quoted(count_col)))
    both = group_count(new, keys, count_col).unionByName(off)
    return (both.groupBy(*[quoted(k) for k in keys]).agg(F.sum(quoted(count_col)).alias(count_col))
            .filter(F.col(quoted(count_col)) != 0))


class MaintainedGold:
    """Silver partitions and their gold counts below ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, partition_by: list[str],
                 group_by: list[str], count_col: str = COUNT):
        self.spark, self.root, self.store = spark, root.rstrip("/"), Store(spark)
        self.schema, self.partition_by, self.group_by, self.count_col = schema, partition_by, group_by, count_col
        self.silver_path = f"{self.root}/silver"

    # ---- state -----------------------------------------------------------

    def _state(self) -> dict:
        """Version and folder of the current gold."""
        text = self.store.read_text(f"{self.root}/GOLD")
        return json.loads(text) if text else {"version": 0, "gold": None}

    def _batch(self, name: str) -> str:
        if not name or not name.replace("-", "").replace("_", "").isalnum():
            raise ValueError("a batch name has letters, digits, hyphens and underscores only")
        return f"{self.root}/batches/{name}"

    def _version_of(self, name: str) -> int | None:
        text = self.store.read_text(f"{self._batch(name)}/VERSION")
        return int(text) if text else None

    def applied(self, name: str) -> bool:
        version = self._version_of(name)
        return version is not None and version <= self._state()["version"]

    def _begin(self, name: str) -> None:
        """Enter the batch as the one in work; another unfinished one is refused."""
        begun = self.store.read_text(f"{self.root}/IN_WORK")
        if begun and begun != name and not self.applied(begun):
            raise RuntimeError(f"batch {begun} is unfinished; apply it again before {name}")
        self.store.replace(f"{self.root}/IN_WORK", name)

    # ---- reading ---------------------------------------------------------

    def silver(self) -> DataFrame:
        if not self.store.exists(self.silver_path):
            return self.spark.createDataFrame([], self.schema)
        stored = read_table(self.spark, self.silver_path, schema=self.schema)
        return decoded(stored, self.partition_by).select(*[quoted(c) for c in self.schema.fieldNames()])

    def _gold_schema(self) -> T.StructType:
        return T.StructType([self.schema[k] for k in self.group_by] + [T.StructField(self.count_col, T.LongType())])

    def gold(self) -> DataFrame:
        """Counts per key over the applied batches, count descending."""
        at = self._state()["gold"]
        rows = (self.spark.createDataFrame([], self._gold_schema()) if at is None
                else read_table(self.spark, f"{self.root}/{at}", schema=self._gold_schema()))
        return order_by_count(rows, self.group_by, self.count_col)

    # ---- a batch ---------------------------------------------------------

    def delta(self, rows: DataFrame) -> DataFrame:
        """Signed counts that ``rows`` bring: only the partitions they land in are read."""
        keys = [quoted(c) for c in self.partition_by]
        old = self.silver().filter(landed_filter(rows.select(*keys).distinct(), self.partition_by))
        return signed_counts(old, rows, self.group_by, self.count_col)

    def apply(self, name: str, rows: DataFrame) -> bool:
        """Replace the partitions of ``rows`` and adjust gold; False if the batch was applied before.

        A batch that was cut short is finished from its stored rows; ``rows`` is
        then not read again.
        """
        path = self._batch(name)
        if self.applied(name):
            return False
        self._begin(name)
        schema = T.StructType([self.schema[c] for c in self.schema.fieldNames()])
        if not self.store.exists(f"{path}/rows/_SUCCESS"):
            write_table(rows.select(*[quoted(c) for c in schema.fieldNames()]), f"{path}/rows", mode="overwrite")
        staged = read_table(self.spark, f"{path}/rows", schema=schema)
        if not self.store.exists(f"{path}/delta/_SUCCESS"):
            write_table(self.delta(staged), f"{path}/delta", mode="overwrite")
        write_table(encoded(staged, self.partition_by), self.silver_path, partition_by=self.partition_by,
                    mode="overwrite", dynamic_overwrite=True)
        self._commit(name, read_table(self.spark, f"{path}/delta", schema=self._gold_schema()))
        self.store.delete(f"{path}/rows")
        return True

    def _commit(self, name: str, delta: DataFrame) -> None:
        state = self._state()
        version = state["version"] + 1
        count = F.col(quoted(self.count_col))
        gold = (self.gold().unionByName(delta).groupBy(*[quoted(k) for k in self.group_by])
                .agg(F.sum(count).alias(self.count_col)).filter(count != 0))
        at = f"gold/version-{version:012d}"
        write_table(gold, f"{self.root}/{at}", mode="overwrite")
        self.store.replace(f"{self._batch(name)}/VERSION", str(version))
        self.store.replace(f"{self.root}/GOLD", json.dumps({"version": version, "gold": at}))
        if version > 2:                                  # readers may be open on the version before
            self.store.delete(f"{self.root}/gold/version-{version - 2:012d}")
