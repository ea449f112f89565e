"""Flatten nested records into ``parent<sep>child`` columns.

Matches the behaviour of a JSON normaliser: nested objects become columns,
arrays stay whole, a lone object is one record and ``[]`` is zero records.
Flattening itself is a projection over ``StructType`` fields (codegen'd, and
Catalyst prunes unused leaves); parsing uses the built-in ``from_json`` once
per value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def flattened_columns(schema: T.StructType, sep: str = ".", prefix: str = "",
                      path: str = "") -> list[Column]:
    """Select list that expands every struct field recursively."""
    cols: list[Column] = []
    for field in schema.fields:
        ref = f"{path}.{_quote(field.name)}" if path else _quote(field.name)
        name = f"{prefix}{sep}{field.name}" if prefix else field.name
        if isinstance(field.dataType, T.StructType) and field.dataType.fields:
            cols.extend(flattened_columns(field.dataType, sep, name, ref))
        else:
            cols.append(F.col(ref).alias(name))
    return cols


def flat_schema(schema: T.StructType, sep: str = ".") -> T.StructType:
    """The schema that ``flattened_columns`` gives; every field may be null."""
    fields: list[T.StructField] = []
    for field in schema.fields:
        if isinstance(field.dataType, T.StructType) and field.dataType.fields:
            fields.extend(T.StructField(f"{field.name}{sep}{f.name}", f.dataType)
                          for f in flat_schema(field.dataType, sep).fields)
        else:
            fields.append(T.StructField(field.name, field.dataType))
    return T.StructType(fields)


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Expand all struct columns of ``df``; arrays and maps are left whole."""
    return df.select(*flattened_columns(df.schema, sep))


def parse_json_column(df: DataFrame, column: str, schema: T.DataType | str,
                      sep: str = ".", keep: list[str] | None = None) -> DataFrame:
    """Parse a JSON text column with a declared schema and flatten the result.

    The struct's leaves are named ``<column><sep><leaf>``; ``keep`` lists the
    other columns to carry along.
    """
    parsed = F.from_json(F.col(_quote(column)), schema)
    keep = keep or []
    tmp = "__parsed"
    out = df.select(*[F.col(_quote(k)) for k in keep], parsed.alias(tmp))
    st = out.schema[tmp].dataType
    if isinstance(st, T.StructType):
        return out.select(*[F.col(_quote(k)) for k in keep],
                          *flattened_columns(st, sep, column, tmp))
    return out.withColumnRenamed(tmp, column)


def explode_records(df: DataFrame, body: str, record_schema: T.StructType,
                    keep: list[str] | None = None, position: str | None = None,
                    sep: str = ".", rescue_col: str | None = None) -> DataFrame:
    """Parse a JSON-array text column and emit one flattened row per element.

    ``[]`` yields no rows; a lone JSON object is treated as a one-element array
    (Spark's ``from_json`` does this with an array schema); unparsable text
    yields no rows.  ``position`` names an optional 0-based element index, so
    crawl order can be kept explicitly as ``(page, position)``.

    ``rescue_col`` keeps what the declared schema does not know: each record's
    unknown keys as JSON text (null when there are none), so a new field is
    neither lost nor turned into a column that empties other pages.
    """
    keep = keep or []
    arr = F.from_json(F.col(_quote(body)), T.ArrayType(record_schema))
    kept = [F.col(_quote(k)) for k in keep]
    if rescue_col:
        known = F.array(*[F.lit(f.name) for f in record_schema.fields])
        text_map = T.MapType(T.StringType(), T.StringType())
        # a lone object is not wrapped into an array for a map schema: do it here
        maps = F.coalesce(F.from_json(F.col(_quote(body)), T.ArrayType(text_map)),
                          F.array(F.from_json(F.col(_quote(body)), text_map)))
        # same body, same order and length: pair each record with its key map
        arr = F.arrays_zip(arr.alias("rec"), maps.alias("raw"))
    if position:
        exploded = df.select(*kept, F.posexplode(arr).alias(position, "__rec"))
        kept_out = kept + [F.col(position)]
    else:
        exploded = df.select(*kept, F.explode(arr).alias("__rec"))
        kept_out = kept
    if not rescue_col:
        return exploded.select(*kept_out, *flattened_columns(record_schema, sep, "", "__rec"))
    extra = F.map_filter(F.col("__rec.raw"), lambda k, v: ~F.array_contains(known, k))
    rescued = F.when(F.size(extra) > 0, F.to_json(extra)).alias(rescue_col)
    return exploded.select(*kept_out, *flattened_columns(record_schema, sep, "", "__rec.rec"),
                           rescued)
