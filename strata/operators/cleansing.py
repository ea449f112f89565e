"""Drop rows with missing values."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.names import quoted


def drop_incomplete(df: DataFrame, how: str = "any", subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN, for floating columns) in ``subset``.

    ``how="any"`` over all columns is the default, as in the reference: a
    column present on one page only is null everywhere else and so removes
    every other row.  Empty strings are values, not missing.  The filter
    stays a plain ``Filter(isnotnull ...)`` node that Catalyst can push into
    the scan.
    """
    if how not in ("any", "all"):
        raise ValueError("how must be 'any' or 'all'")
    names = df.columns if subset is None else subset
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("float", "double")}
    present = [F.col(quoted(c)).isNotNull() & ~F.isnan(quoted(c)) if c in floats
               else F.col(quoted(c)).isNotNull() for c in names]
    if not present:
        return df
    return df.filter(reduce(and_ if how == "any" else or_, present))
