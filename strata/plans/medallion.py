"""the medallion flow -- bronze JSON, partitioned silver, gold counts, serving.

Built from the S/K/P/A/O operators.  Differences from a naive job, each for a
reason given in the survey (section 2.8):

* bronze is read back with the declared schema (no inference pass, no type
  widening, no lost all-null columns, microsecond timestamps);
* gold and serving read **silver** (columnar, typed, pruned), not bronze;
* default modes make a rerun succeed (create-only stays available);
* no step reads and overwrites the same folder;
* counts per layer come from observations taken during the writes.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.names import quoted
from strata.functions.schemas import JSON_TS_OPTIONS
from strata.operators.aggregates import COUNT, group_count, order_by_count
from strata.operators.cleansing import drop_incomplete
from strata.plans.report import RunReport
from strata.sinks.files import write_json, write_table
from strata.sinks.partition_codec import decode_sql, decoded, encoded
from strata.sources.files import read_json, read_table

log = logging.getLogger(__name__)


@dataclass
class MedallionParams:
    """job parameters (storage root, layout, modes, serving connection)."""

    root: str
    partition_by: list[str]
    group_by: list[str]
    table_format: str = "parquet"
    # write-mode policy per layer.
    bronze_mode: str = "overwrite"
    silver_mode: str = "overwrite"
    gold_mode: str = "overwrite"
    dynamic_silver: bool = False
    # Adaptive rebalance of silver on its partition columns: without it every
    # task writes a file per value.
    optimize_writes: bool = True
    # Adaptive rebalance of bronze, for sources of few partitions (a crawl).
    rebalance_bronze: bool = False
    # Text codec for bronze ("gzip", "bzip2", "deflate", ...; None = plain).
    # Compressed JSON files are not splittable, but optimized writes keep each
    # file near the advisory partition size, so silver still reads in parallel.
    bronze_compression: str | None = None
    # String partition values that come back as written ("" is not null): see
    # strata.sinks.partition_codec.
    reversible_partitions: bool = True
    # Where incomplete rows are dropped ("bronze" as in the reference,
    # "silver" to keep bronze raw, or None) and over which columns.
    drop_incomplete_at: str | None = "bronze"
    drop_subset: list[str] | None = None
    schema: T.StructType | None = None
    # Silver types of columns that bronze holds as text (column -> SQL type); a
    # value that does not fit becomes null, after incomplete rows were dropped.
    casts: dict[str, str] = field(default_factory=dict)
    jdbc: dict | None = None
    jdbc_mode: str = "overwrite"
    # Many distinct partition values mean many small silver folders and files.
    # Their number is estimated while bronze is written (approx_count_distinct
    # in the bronze observation, no extra pass); above this a warning is logged.
    max_partition_values: int | None = 10_000
    # Which layer the serving table receives: "silver" (every record, as the
    # reference does) or "gold" (the small aggregate -- what a row store
    # should get when silver is large).
    serving_layer: str = "silver"
    count_col: str = COUNT

    @property
    def coded(self) -> list[str]:
        """Partition columns whose values are encoded in folder names."""
        return self.partition_by if self.reversible_partitions else []

    @property
    def bronze_path(self) -> str:
        return f"{self.root.rstrip('/')}/bronze"

    @property
    def silver_path(self) -> str:
        return f"{self.root.rstrip('/')}/silver"

    @property
    def gold_path(self) -> str:
        return f"{self.root.rstrip('/')}/gold"


@dataclass
class MedallionResult:
    params: MedallionParams
    counts: dict[str, int]
    silver: DataFrame
    gold: DataFrame
    # For a crawl: the records as fetched, with ``page`` and ``position``.
    records: DataFrame | None = None


def gold_schema(schema: T.StructType, keys: list[str], count_col: str = COUNT) -> T.StructType:
    return T.StructType([schema[k] for k in keys] + [T.StructField(count_col, T.LongType(), False)])


def read_silver(spark: SparkSession, p: MedallionParams, schema: T.StructType) -> DataFrame:
    # Declared schema keeps partition values typed as declared; the select puts
    # the partition columns back in record order.
    stored = read_table(spark, p.silver_path, p.table_format, schema)
    return decoded(stored, p.coded).select(*[quoted(c) for c in schema.fieldNames()])


def read_gold(spark: SparkSession, p: MedallionParams, schema: T.StructType) -> DataFrame:
    # Stored row order is not a promise (2.8 #15): sort again on read.
    g = read_table(spark, p.gold_path, p.table_format, gold_schema(schema, p.group_by, p.count_col))
    return order_by_count(g, p.group_by, p.count_col)


def cast_columns(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """The columns of ``casts`` converted to their SQL types, null where a value does not fit."""
    unknown = set(casts) - set(df.columns)
    if unknown:
        raise ValueError(f"casts name no column of the records: {sorted(unknown)}")
    return df.select(*[F.col(quoted(c)).try_cast(casts[c]).alias(c) if c in casts else F.col(quoted(c))
                       for c in df.columns])


def _check_partition_values(estimate, p: MedallionParams) -> None:
    if estimate is None or not p.max_partition_values or estimate <= p.max_partition_values:
        return
    msg = (f"silver partitioning on {p.partition_by} would create about {estimate} partition "
           f"folders (limit {p.max_partition_values}); choose a coarser column")
    log.warning(msg)


def _stored(spark: SparkSession, path: str, fmt: str, schema: T.StructType):
    """Fallback row count of a written layer (used only when no metrics arrived)."""
    return lambda: read_table(spark, path, fmt, schema).count()


def serve(p: MedallionParams, silver: DataFrame, gold: DataFrame) -> None:
    """Replace the serving table with the layer that ``p`` names."""
    from strata.sinks.jdbc import write_jdbc

    write_jdbc(silver if p.serving_layer == "silver" else gold, mode=p.jdbc_mode, **p.jdbc)


def run_medallion(spark: SparkSession, source: DataFrame, p: MedallionParams) -> MedallionResult:
    """Run bronze -> silver -> gold (-> serving) and return counts and read-back frames."""
    if p.drop_incomplete_at not in (None, "bronze", "silver"):
        raise ValueError("drop_incomplete_at must be 'bronze', 'silver' or None")
    if p.serving_layer not in ("silver", "gold"):
        raise ValueError("serving_layer must be 'silver' or 'gold'")
    schema = p.schema or source.schema
    report = RunReport()

    # Bronze: JSON lines, overwritten each run.
    bronze_in = source.select(*[F.col(f"`{c}`") for c in schema.fieldNames()])
    if p.drop_incomplete_at == "bronze":
        bronze_in = drop_incomplete(bronze_in, subset=p.drop_subset)
    extra = {}
    if p.partition_by and p.max_partition_values:
        keys = [F.col(f"`{c}`") for c in p.partition_by]
        extra["partition_values"] = F.approx_count_distinct(keys[0] if len(keys) == 1
                                                            else F.struct(*keys))
    write_json(bronze_in, p.bronze_path, mode=p.bronze_mode, rebalance=p.rebalance_bronze,
               compression=p.bronze_compression,
               observe=report.tap("bronze", _stored(spark, p.bronze_path, "json", schema), extra))
    _check_partition_values(report.metric("bronze", "partition_values"), p)

    # Silver: declared-schema read of bronze, partitioned columnar table.
    bronze = read_json(spark, p.bronze_path, schema)
    if p.drop_incomplete_at == "silver":
        bronze = drop_incomplete(bronze, subset=p.drop_subset)
    if p.casts:
        bronze = cast_columns(bronze, p.casts)
        schema = bronze.schema
    write_table(encoded(bronze, p.coded), p.silver_path, p.table_format, partition_by=p.partition_by,
                mode=p.silver_mode, dynamic_overwrite=p.dynamic_silver,
                rebalance=p.optimize_writes,
                observe=report.tap("silver", _stored(spark, p.silver_path, p.table_format, schema)))

    # Gold: grouped count over silver, sorted when it is read (stored order is no promise).
    silver = read_silver(spark, p, schema)
    gold = group_count(silver, p.group_by, p.count_col)
    gsch = gold_schema(schema, p.group_by, p.count_col)
    write_table(gold, p.gold_path, p.table_format, mode=p.gold_mode,
                observe=report.tap("gold", _stored(spark, p.gold_path, p.table_format, gsch)))

    # Serving: a relational table, fed from the stored layer.
    gold_read = read_gold(spark, p, schema)
    if p.jdbc:
        serve(p, silver, gold_read)

    counts = report.counts()
    log.info("medallion counts: %s", counts)
    return MedallionResult(p, counts, silver, gold_read)


def register_layers(spark: SparkSession, p: MedallionParams, schema: T.StructType,
                    prefix: str = "", database: str | None = None) -> list[str]:
    """Expose the layers as external catalog tables (metadata only; the
    data stays where the flow wrote it).  Returns the table names.  Where silver's
    partition values are encoded, the view ``<prefix>silver_values`` gives them as they were written."""
    db = f"`{database}`." if database else ""
    stored = cast_columns(spark.createDataFrame([], schema), p.casts).schema
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    layers = [("bronze", p.bronze_path, "json", schema),
              ("silver", p.silver_path, p.table_format, stored),
              ("gold", p.gold_path, p.table_format, gold_schema(stored, p.group_by, p.count_col))]
    names = []
    for layer, path, fmt, sch in layers:
        parts = p.partition_by if layer == "silver" else []
        coded = [c for c in p.coded if isinstance(sch[c].dataType, T.StringType)] if parts else []
        name = f"{db}`{prefix}{layer}`"
        values = f"{db}`{prefix}{layer}_values`"
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sch.fields)
        part_sql = ("PARTITIONED BY (" + ", ".join(f"`{c}`" for c in parts) + ") ") if parts else ""
        spark.sql(f"DROP VIEW IF EXISTS {values}")
        spark.sql(f"DROP TABLE IF EXISTS {name}")      # external: drops metadata only
        opts = ""
        if fmt == "json":   # same text formats the bronze writer used
            esc = {k: v.replace("\\", "\\\\").replace("'", "\\'") for k, v in JSON_TS_OPTIONS.items()}
            opts = "OPTIONS (" + ", ".join(f"'{k}' '{v}'" for k, v in esc.items()) + ") "
        spark.sql(f"CREATE TABLE {name} ({cols}) USING {fmt} {opts}{part_sql}LOCATION '{path}'")
        if parts:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        if coded:           # folder names hold encoded values: a view gives them as they were written
            spark.sql(f"CREATE VIEW {values} AS SELECT " + ", ".join(
                f"{decode_sql(f.name)} AS `{f.name}`" if f.name in coded else f"`{f.name}`" for f in sch.fields)
                + f" FROM {name}")
        names.append(name.replace("`", ""))
    return names


def medallion_job(source_factory, params: MedallionParams, spark: SparkSession | None = None,
                  app_name: str = "strata-medallion") -> MedallionResult:
    """fail loud; stop the session only if this call created it."""
    owned = spark is None
    if owned:
        from strata.session import build_session

        spark = build_session(app_name, profile="cluster")
    try:
        return run_medallion(spark, source_factory(spark), params)
    except Exception:
        log.exception("medallion job failed")
        raise
    finally:
        if owned:
            spark.stop()
