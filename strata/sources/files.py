"""S3: JSON directory scans; columnar table reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.functions.schemas import JSON_TS_OPTIONS


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
              ts_patterns: bool = False, **options) -> DataFrame:
    """Read JSON lines.  With ``schema`` no inference pass runs and columns keep
    their declared types and order; without it Spark infers (an extra full
    pass; ints widen to bigint, columns come back sorted by name).

    Bronze timestamps are written as ISO-8601 with microseconds, which Spark's
    default parser reads exactly (and a little faster than a pattern), so the
    write patterns are applied on read only with ``ts_patterns=True``.
    """
    r = spark.read.options(**(JSON_TS_OPTIONS if ts_patterns else {})).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None) -> DataFrame:
    """Read a (possibly partitioned) table.  A declared schema keeps partition
    values typed as declared (``"01"`` stays a string)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def read_testdata(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
