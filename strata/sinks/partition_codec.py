"""Partition values that come back as they were written.

A partition folder cannot tell an empty string from a missing value: Spark writes
both as its default partition.  The codec keeps one escape, ``~``: an empty
string becomes ``~``, a value that begins with ``~`` gets one more, every other
value stays as it is (Spark itself escapes ``/``, ``:`` and the like in folder
names).  Null stays null.  Decoding is an expression over the partition column,
so a filter on the decoded column is still a partition filter.

Only string columns need it; other types pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.names import quoted

ESCAPE = "~"


def _strings(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]


def encode(value: Column) -> Column:
    return F.when((value == "") | value.startswith(ESCAPE), F.concat(F.lit(ESCAPE), value)).otherwise(value)


def decode(value: Column) -> Column:
    return F.when(value.startswith(ESCAPE), F.substr(value, F.lit(len(ESCAPE) + 1))).otherwise(value)


def decode_sql(name: str) -> str:
    """``decode`` as SQL text, for views."""
    c = quoted(name)
    return f"CASE WHEN startswith({c}, '{ESCAPE}') THEN substr({c}, {len(ESCAPE) + 1}) ELSE {c} END"


def encoded(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with its string partition columns as they go into folder names."""
    names = _strings(df, columns)
    return df.withColumns({c: encode(F.col(quoted(c))) for c in names}) if names else df


def decoded(df: DataFrame, columns: list[str]) -> DataFrame:
    """Inverse of ``encoded`` on a table that was read back."""
    names = _strings(df, columns)
    return df.withColumns({c: decode(F.col(quoted(c))) for c in names}) if names else df
