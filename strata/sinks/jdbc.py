"""Relational serving sinks: replace (K4), create-if-absent (K5), stamped append (K6).

These use Spark's JDBC writer.  No database ships with this repository and
none is started by it; the functions take the connection from the caller.
Credentials come from arguments or from environment variables named by the
caller, and are never logged.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _complex_to_json(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs become JSON text: generic JDBC dialects cannot
    bind ``array<float>`` (2.8 #17)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            cols.append(F.to_json(F.col(f"`{f.name}`")).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, user_env: str | None = None,
                 password_env: str | None = None, batch_size: int = 10_000,
                 num_partitions: int = 8, truncate: bool = False,
                 column_types: str | None = None) -> dict[str, str]:
    """Writer options.  ``num_partitions`` caps concurrent connections."""
    if user is None and user_env:
        user = os.environ.get(user_env)
    if password is None and password_env:
        password = os.environ.get(password_env)
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size),
            "truncate": str(truncate).lower()}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    opts["numPartitions"] = str(num_partitions)
    if column_types:
        opts["createTableColumnTypes"] = column_types
    return opts


def write_jdbc(df: DataFrame, mode: str = "overwrite", arrays_as_json: bool = True,
               **conn) -> None:
    """K4: replace (``overwrite``) or extend (``append``) a serving table.

    ``overwrite`` drops and recreates the table unless ``truncate=True``,
    which keeps its definition (and is what readers of a live table want).
    """
    out = _complex_to_json(df) if arrays_as_json else df
    out.write.format("jdbc").options(**jdbc_options(**conn)).mode(mode).save()


def append_jdbc_stamped(df: DataFrame, ts_col: str = "timestamp", **conn) -> None:
    """K5 + K6: append rows stamped with the write time; the first append
    creates the table (column types from ``column_types``)."""
    write_jdbc(df.withColumn(ts_col, F.current_timestamp()), mode="append", **conn)
