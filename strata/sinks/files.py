"""File sinks: bronze JSON (K1), partitioned and plain tables (K2, K3),
single-object publish (K7), stamped append (K6 on files).

``fmt`` is a parameter everywhere (default ``parquet``); ``delta`` or any other
format whose jar is on the classpath is passed straight through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.names import quoted
from strata.functions.schemas import JSON_TS_OPTIONS
from strata.sinks.store import Store, scan_roots

# A function applied to the frame right before it is written (after any
# rebalance), e.g. to attach an Observation.  Placed there, the observed
# metrics are collected in the write's result stage, where each partition's
# update is applied exactly once even if earlier stages are re-run.
Tap = Callable[[DataFrame], DataFrame]


def assert_not_reading(df: DataFrame, path: str) -> None:
    """Refuse an overwrite of a folder that ``df`` itself reads (data loss, 2.8 #12).

    The roots of the scans are compared, not their files: one path per reader,
    whatever the number of files below it.
    """
    store = Store(df.sparkSession)
    target = store.qualified(path)
    for root in scan_roots(df):
        src = store.qualified(root)
        if src == target or src.startswith(target + "/") or target.startswith(src + "/"):
            raise ValueError(f"refusing to overwrite {path}: the DataFrame reads from it")


def _hashable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.ArrayType):
        return _hashable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_hashable(f.dataType) for f in dt.fields)
    return True


def rebalance_evenly(df: DataFrame) -> DataFrame:
    """An adaptive rebalance that spreads rows evenly and repeats exactly on retry.

    Round-robin would make Spark sort every map partition first (so that a
    retried task sends each row to the same place); hashing on the row's
    columns is deterministic without that sort.  Identical rows land together,
    and adaptive execution splits such a skewed partition at map-block
    boundaries.  Map-typed columns cannot be hashed and are left out; with
    none left, round-robin it is.
    """
    keys = [quoted(f.name) for f in df.schema.fields if _hashable(f.dataType)]
    return df.hint("rebalance", *keys) if keys else df.hint("rebalance")


def write_json(df: DataFrame, path: str, mode: str = "overwrite",
               write_nulls: bool = True, compression: str | None = None,
               rebalance: bool = False, observe: Tap | None = None) -> None:
    """K1: JSON lines, lossless for timestamps (microseconds) and all-null columns.

    ``rebalance`` adds one adaptive exchange (``rebalance_evenly``) before the write
    (an "optimized write"): output files come out near the advisory partition
    size and an input of few partitions (a crawl) is serialised by many tasks.
    By default the rows are written as they are read.
    """
    if mode == "overwrite":
        assert_not_reading(df, path)
    if rebalance:
        df = rebalance_evenly(df)
    if observe:
        df = observe(df)
    w = df.write.mode(mode).options(**JSON_TS_OPTIONS)
    w = w.option("ignoreNullFields", str(not write_nulls).lower())
    if compression:
        w = w.option("compression", compression)
    w.json(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None, mode: str = "errorifexists",
                dynamic_overwrite: bool = False, rebalance: bool = True,
                observe: Tap | None = None) -> None:
    """K2/K3: write a table, optionally partitioned by columns.

    With ``partition_by`` the rows are first rebalanced on those columns
    (``REBALANCE`` hint): each task then writes few partition folders, so the
    file count stays near (values x a few) instead of (tasks x values), and
    adaptive execution splits a hot value across several tasks rather than
    sending a third of the table to one writer.  ``dynamic_overwrite`` replaces
    only the partitions present in ``df`` (rerunnable silver).  ``observe`` is a
    ``Tap`` (see above).
    """
    if mode == "overwrite":
        assert_not_reading(df, path)
    if partition_by and rebalance:
        df = df.hint("rebalance", *[quoted(c) for c in partition_by])
    if observe:
        df = observe(df)
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if dynamic_overwrite:
        w = w.option("partitionOverwriteMode", "dynamic")
    if fmt == "json":
        w = w.options(**JSON_TS_OPTIONS)
    w.save(path)


def name_single_part(spark: SparkSession, path: str, object_name: str) -> str | None:
    """Give the one ``part-*`` file of an output folder a stable name, through the
    session's file systems (the store that the writer used).  Returns the new
    path, or None when the folder does not hold exactly one part file."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    root = Path(path)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    parts = [s.getPath() for s in fs.listStatus(root)
             if s.isFile() and s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        return None
    target = Path(root, object_name)
    if not fs.rename(parts[0], target):
        raise OSError(f"could not rename {parts[0]} to {target}")
    return target.toString()


def publish_single_object(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite",
                          object_name: str | None = None) -> None:
    """K7: write a result as one object (one part file).

    One task writes all rows, so this is for aggregates such as gold (one row
    per group); what grows with the data goes through ``write_table``.
    ``object_name`` renames the part file, so consumers find the object at
    ``<path>/<object_name>``.
    """
    if mode == "overwrite":
        assert_not_reading(df, path)
    w = df.coalesce(1).write.format(fmt).mode(mode)
    if fmt in ("json", "csv"):
        w = w.options(**JSON_TS_OPTIONS)
    w.save(path)
    if object_name and name_single_part(df.sparkSession, path, object_name) is None:
        raise OSError(f"{path} does not hold exactly one part file to name {object_name}")


def append_stamped(df: DataFrame, path: str, fmt: str = "parquet",
                   ts_col: str = "timestamp") -> None:
    """K6 on files: append rows stamped with the write time (a column default)."""
    df.withColumn(ts_col, F.current_timestamp()).write.format(fmt).mode("append").save(path)


class OnceLog:
    """K6 with batch names: a stamped append that a retried job cannot repeat.

    The rows of a batch go to a folder of their own, ``<path>/rows/batch=<name>``,
    written whole or replaced whole.  Then one small object, ``<path>/commits/<name>``,
    is created; the batch belongs to the table from that moment.  A retry after the
    commit does nothing; a retry of a batch that was cut short before it replaces the
    folder, so its rows are there once, with the stamp of the attempt that counted.
    """

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet", ts_col: str = "timestamp"):
        self.spark, self.path, self.fmt, self.ts_col = spark, path.rstrip("/"), fmt, ts_col
        self.store = Store(spark)

    def _rows(self, batch: str) -> str:
        if not batch or not batch.replace("-", "").replace("_", "").isalnum():
            raise ValueError("a batch name has letters, digits, hyphens and underscores only")
        return f"{self.path}/rows/batch={batch}"

    def batches(self) -> list[str]:
        """Names of the committed batches."""
        return self.store.names(f"{self.path}/commits")

    def write(self, df: DataFrame, batch: str) -> None:
        """Store the rows of a batch without committing them."""
        write_table(df.withColumn(self.ts_col, F.current_timestamp()), self._rows(batch), self.fmt, mode="overwrite")

    def commit(self, batch: str) -> None:
        self.store.create(f"{self.path}/commits/{batch}")

    def append(self, df: DataFrame, batch: str) -> bool:
        """Add a batch; False if it was added before."""
        self._rows(batch)
        if self.store.exists(f"{self.path}/commits/{batch}"):
            return False
        self.write(df, batch)
        self.commit(batch)
        return True

    def read(self, schema: T.StructType) -> DataFrame:
        """Rows of the committed batches with their ``batch``; others are not scanned."""
        names = self.batches()
        full = T.StructType([*schema.fields, T.StructField(self.ts_col, T.TimestampType()),
                             T.StructField("batch", T.StringType())])
        if not names:
            return self.spark.createDataFrame([], full)
        return (self.spark.read.format(self.fmt).schema(full).option("basePath", f"{self.path}/rows")
                .load([self._rows(n) for n in names]))
