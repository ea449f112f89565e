"""F1 as an incremental Structured Streaming job.

A scheduled run of the batch flow rewrites every layer from scratch.  Here each
layer is a streaming query with its own checkpoint, started with the
``availableNow`` trigger: a run processes exactly the files that landed since
the previous run and stops, so the work per run grows with the new data, not
with the history.

* bronze: file stream of the landing folder -> JSON file sink (append);
* silver: file stream of bronze (declared schema, read through the bronze
  sink's metadata log, so only committed files are seen) -> partitioned
  columnar file sink (append);
* gold: streaming count over silver in ``complete`` mode.  The running counts
  live in the state store (one entry per group) and every micro-batch
  rewrites the small gold table through ``foreachBatch``; replaying a batch
  after a failure writes the same result again.

Checkpoints go under the shared ``spark.checkpoint.dir`` unless a root is given.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.names import quoted
from strata.functions.schemas import JSON_TS_OPTIONS
from strata.operators.aggregates import group_count
from strata.operators.cleansing import drop_incomplete
from strata.plans.medallion import MedallionParams, cast_columns, gold_schema, read_gold
from strata.session import scratch_path
from strata.sinks.files import write_table
from strata.sinks.partition_codec import decoded, encoded
from strata.sinks.store import Store


@dataclass
class IncrementalRun:
    """Rows that the bronze and silver queries stored in this run, and the gold table."""

    bronze_rows: int
    silver_rows: int
    gold: DataFrame


#: Batches of one run whose progress is kept, so that no stored row goes uncounted.
PROGRESS = ("spark.sql.streaming.numRecentProgressUpdates", str(2**31 - 1))


def _counted(df: DataFrame) -> DataFrame:
    return df.observe("stored", F.count(F.lit(1)).alias("n"))


def _rows(query) -> int:
    seen = [p.observedMetrics.get("stored") for p in query.recentProgress]
    return sum(r["n"] for r in seen if r is not None)


def run_incremental_medallion(spark: SparkSession, source_path: str, source_format: str,
                              p: MedallionParams, checkpoint_root: str | None = None,
                              max_files_per_trigger: int | None = None) -> IncrementalRun:
    """Process newly landed source files through bronze, silver and gold, then stop."""
    if p.schema is None:
        raise ValueError("the incremental flow needs a declared schema (MedallionParams.schema)")
    if p.jdbc:
        raise ValueError("the incremental flow has no serving table; write one from its gold")
    schema: T.StructType = p.schema
    ck = (checkpoint_root or scratch_path(spark, "incremental-ckpt")).rstrip("/")

    # Bronze
    src = spark.readStream.schema(schema).format(source_format)
    if source_format == "json":
        src = src.options(**JSON_TS_OPTIONS)
    if max_files_per_trigger:
        src = src.option("maxFilesPerTrigger", int(max_files_per_trigger))
    bronze_in = src.load(source_path).select(*[quoted(c) for c in schema.fieldNames()])
    if p.drop_incomplete_at == "bronze":
        bronze_in = drop_incomplete(bronze_in, subset=p.drop_subset)
    kept = spark.conf.get(PROGRESS[0])
    spark.conf.set(*PROGRESS)
    try:
        qb = (_counted(bronze_in).writeStream.format("json").options(**JSON_TS_OPTIONS)
              .option("ignoreNullFields", "false")
              .option("checkpointLocation", f"{ck}/bronze")
              .trigger(availableNow=True).start(p.bronze_path))
        qb.awaitTermination()

        # Silver (a run that found nothing to land yet has no bronze folder)
        store = Store(spark)
        store.make_folder(p.bronze_path)
        silver_in = (spark.readStream.schema(schema).options(**JSON_TS_OPTIONS).json(p.bronze_path))
        if p.drop_incomplete_at == "silver":
            silver_in = drop_incomplete(silver_in, subset=p.drop_subset)
        if p.casts:
            silver_in = cast_columns(silver_in, p.casts)
            schema = silver_in.schema
        qs = (_counted(encoded(silver_in, p.coded)).writeStream.format(p.table_format).partitionBy(*p.partition_by)
              .option("checkpointLocation", f"{ck}/silver")
              .trigger(availableNow=True).start(p.silver_path))
        qs.awaitTermination()
    finally:
        spark.conf.set(PROGRESS[0], kept)

    # Gold
    store.make_folder(p.silver_path)
    keys = p.group_by

    def publish(batch: DataFrame, _batch_id: int) -> None:
        write_table(batch, p.gold_path, p.table_format, mode="overwrite")

    silver = spark.readStream.schema(schema).format(p.table_format).load(p.silver_path)
    counts = group_count(decoded(silver, p.coded), keys, p.count_col)
    qg = (counts.writeStream.outputMode("complete").foreachBatch(publish)
          .option("checkpointLocation", f"{ck}/gold")
          .trigger(availableNow=True).start())
    qg.awaitTermination()
    if not store.exists(p.gold_path):                    # no batch so far: gold is an empty table
        publish(spark.createDataFrame([], gold_schema(schema, keys, p.count_col)), 0)

    return IncrementalRun(_rows(qb), _rows(qs), read_gold(spark, p, schema))
