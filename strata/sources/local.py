"""Small local data (fixtures, driver-side lists) to a DataFrame.

Always with a declared schema: inference fails on an empty input
(``CANNOT_INFER_EMPTY_SCHEMA``) and guesses types from whatever arrived.  Only
for data that is small by construction; anything that grows with the input
is read by a source instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def local_frame(spark: SparkSession, data, schema: T.StructType | str) -> DataFrame:
    """``data``: a list of tuples/dicts or a pandas DataFrame (Arrow path)."""
    try:
        import pandas as pd

        if isinstance(data, pd.DataFrame):
            names = schema.fieldNames() if isinstance(schema, T.StructType) else None
            if names is not None:
                data = data.reindex(columns=names)
            # absent columns and NaN placeholders become real nulls
            data = data.astype(object).where(data.notna(), None)
    except ImportError:  # pragma: no cover
        pass
    return spark.createDataFrame(data, schema)
