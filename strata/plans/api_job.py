"""The whole job: crawl a paged JSON API into the medallion layers.

crawl (S1, F3) -> store the page envelopes group by group -> route (P4) ->
flatten (P1) -> ``run_medallion`` (F1).  Pages are fetched by Spark tasks and
stored once in the shared checkpoint folder, so records and failed-page rows
never trigger a second fetch; after the loss of an executor only the pages of
the group in work are fetched again.  Everything after the fetch is DataFrame
expressions.
"""

from __future__ import annotations

import logging
import re
import uuid
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.flatten import flat_schema
from strata.functions.names import quoted
from strata.functions.schemas import BREWERY_CASTS, BREWERY_SCHEMA
from strata.operators.routing import HTTP_ERROR, UNPARSABLE, outcome_column, route_pages
from strata.operators.union import union_by_name
from strata.plans.drift import SchemaHistory, profile
from strata.plans.lineage import cut_lineage
from strata.plans.medallion import MedallionParams, MedallionResult, run_medallion
from strata.plans.publish import POINTER, run_published
from strata.session import scratch_path
from strata.sinks.files import write_json
from strata.sinks.store import Store
from strata.sources.paged_json import SCHEMA, read_pages
from strata.streaming.crawl_stream import crawl_stream

log = logging.getLogger(__name__)

#: Pages that a task fetches before they are stored.
PAGES_PER_TASK = 500


def crawl_pages(spark: SparkSession, url: str, first: int, last: int, per_page: int = 200,
                pause_seconds: float = 0.0, concurrency: int = 1,
                pages_per_task: int = PAGES_PER_TASK, store: str | None = None,
                pages_per_file: int = 1, requests_per_second: float = 0.0) -> DataFrame:
    """Fetch pages ``first..last`` once and store their envelopes.

    A group of ``concurrency * pages_per_task`` pages is one job with its own
    output folder.  With a ``store`` that outlives the run the crawl is a
    checkpointed stream (``strata.streaming.crawl_stream``): a later call with the
    same URL template fetches only what is not there or was no good page.
    """
    size = max(1, concurrency) * max(1, pages_per_task)
    rate = {"pause_seconds": pause_seconds, "concurrency": concurrency, "requests_per_second": requests_per_second}
    if store:
        return crawl_stream(spark, url, first, last, store, per_page, size, pages_per_file, **rate)
    root, folders = scratch_path(spark, "crawl-pages").rstrip("/"), []
    step = 1 if last >= first else -1
    for begin in range(first, last + step, step * size):
        end = min(begin + size - 1, last) if step > 0 else max(begin - size + 1, last)
        folders.append(f"{root}/pages-{begin}-to-{end}")
        (read_pages(spark, url, begin, end, per_page=per_page, pages_per_file=pages_per_file, **rate)
         .write.mode("overwrite").parquet(folders[-1]))
    return spark.read.schema(SCHEMA).parquet(*folders)


def infer_record_schema(envelopes: DataFrame) -> T.StructType:
    """The schema of the records of all good pages, by one aggregate in the JVM.

    Fields whose values differ in kind, or that are always null, are strings.
    """
    records = record_texts(envelopes)
    found = (records.select(F.try_parse_json("record").alias("rec")).filter("schema_of_variant(rec) LIKE 'OBJECT<%'")
             .agg(F.schema_of_variant_agg("rec").alias("s")).first()[0])
    kinds = {"OBJECT<": "STRUCT<", "VARIANT": "STRING", "VOID": "STRING"}
    ddl = re.sub(r"`(?:[^`]|``)*`|\b(?:OBJECT<|VARIANT\b|VOID\b)(?!:)",
                 lambda m: kinds.get(m[0], m[0]), found or "VOID")
    schema = T.DataType.fromDDL(ddl)
    if not isinstance(schema, T.StructType):
        raise RuntimeError("no page of the crawl holds a record; the stored layers are left as they are")
    return schema


def crawl_records(spark: SparkSession, url: str, first: int, last: int, per_page: int = 200,
                  pause_seconds: float = 0.0, concurrency: int = 1,
                  record_schema: T.StructType = BREWERY_SCHEMA, id_field: str = "id",
                  rescue_col: str | None = None, pages_per_file: int = 1) -> tuple[DataFrame, DataFrame]:
    """Fetch pages ``first..last`` once; return (records, failed-page sentinel rows).

    Records carry ``page`` and ``position`` so the crawl order is explicit.
    """
    env = crawl_pages(spark, url, first, last, per_page, pause_seconds, concurrency, pages_per_file=pages_per_file)
    return route_pages(env, record_schema, id_field=id_field, rescue_col=rescue_col)


def run_api_medallion(spark: SparkSession, url: str, root: str, first: int = 40, last: int = 1,
                      per_page: int = 200, pause_seconds: float = 1.0, concurrency: int = 1,
                      record_schema: T.StructType | str | None = BREWERY_SCHEMA,
                      id_field: str = "id", partition_by: list[str] | None = None,
                      group_by: list[str] | None = None, casts: dict[str, str] | None = None,
                      failed_pages: str = "audit", table_format: str = "parquet",
                      jdbc: dict | None = None, rescue_col: str | None = None,
                      allow_incomplete: bool = False, allow_empty: bool = False, store: str | None = None,
                      pages_per_file: int = 1, requests_per_second: float = 0.0,
                      publish_runs: bool = False, on_drift: str | None = None,
                      **params) -> MedallionResult:
    """Crawl, then bronze, silver (by ``partition_by``) and gold (by ``group_by``).

    ``record_schema`` is a struct type or its DDL; ``None`` infers it from all
    pages.  Nested objects become dotted columns, which ``partition_by``,
    ``group_by`` and ``casts`` (column -> SQL type, applied at silver, where a
    value that does not fit becomes null) name as such.  The defaults are those
    of the brewery API.

    ``failed_pages``: ``"audit"`` writes sentinel rows to ``<root>/failed_pages``;
    ``"inline"`` unions them into the records (they then drop out at P3 unless
    ``drop_incomplete_at`` is None); ``"drop"`` ignores them.  ``rescue_col``
    carries keys the record schema does not know into every layer as JSON text;
    the incomplete-row check then looks at the declared fields only.

    A page that could not be fetched or parsed ends the job before any layer is
    overwritten (the audit names it), unless ``allow_incomplete`` is set; empty
    pages are no failures.  Records that have none of the declared fields always end
    it, and so does a crawl without records over layers that exist, unless
    ``allow_empty`` is set; the first run of a lake may be empty.

    ``store`` keeps the fetched pages, so that a stopped crawl is taken up.
    ``publish_runs`` writes to a run folder and makes it current by one swap
    (``strata.plans.publish``).  ``on_drift``: ``"report"`` logs how the records'
    fields moved since the last run, ``"refuse"`` also ends the job before bronze is
    touched where a field was dropped or came into conflict.
    """
    if failed_pages not in ("audit", "inline", "drop"):
        raise ValueError("failed_pages must be 'audit', 'inline' or 'drop'")
    brewery = record_schema is BREWERY_SCHEMA
    if partition_by is None or group_by is None:
        if not brewery:
            raise ValueError("another record schema needs partition_by and group_by")
        partition_by = ["state_province"] if partition_by is None else partition_by
        group_by = ["state_province", "brewery_type"] if group_by is None else group_by
    casts = (BREWERY_CASTS if brewery else {}) if casts is None else casts
    if on_drift not in (None, "report", "refuse"):
        raise ValueError("on_drift must be 'report', 'refuse' or None")
    env = crawl_pages(spark, url, first, last, per_page, pause_seconds, concurrency, store=store,
                      pages_per_file=pages_per_file, requests_per_second=requests_per_second)
    lost_pages = env.filter(outcome_column().isin(HTTP_ERROR, UNPARSABLE)).count()
    failure = f"{lost_pages} pages of the crawl failed; the stored layers are left as they are"
    if record_schema is None:
        if env.filter("status = 200").isEmpty():
            raise RuntimeError(failure)
        record_schema = infer_record_schema(env)
    elif isinstance(record_schema, str):
        record_schema = T.DataType.fromDDL(record_schema)
    flat = flat_schema(record_schema)
    holds_url = id_field in flat.fieldNames() and isinstance(flat[id_field].dataType, T.StringType)
    crawled, sentinels = route_pages(env, record_schema, id_field=id_field, rescue_col=rescue_col,
                                     keep_url=None if holds_url or failed_pages == "inline" else "page_url")
    if failed_pages == "audit":
        write_json(sentinels.withColumn("logged_at", F.current_timestamp()),
                   f"{root.rstrip('/')}/failed_pages", mode="append")
    fields = flat.fieldNames()
    known = reduce(or_, [F.col(quoted(c)).isNotNull() for c in fields])
    unknown = crawled.filter(known).isEmpty()
    nothing = unknown and crawled.isEmpty()
    if lost_pages and (not allow_incomplete or nothing):
        raise RuntimeError(failure)
    if unknown and not nothing:
        raise RuntimeError("no record has any of the declared fields; the stored layers are left as they are")
    if nothing and not allow_empty and _layers_exist(spark, root):
        raise RuntimeError("the crawl has no records; the stored layers are left as they are (allow_empty)")
    history = SchemaHistory(spark, root) if on_drift else None
    if history:
        shape = cut_lineage(profile(record_texts(env)), "schema-profile")
        for r in history.check(shape, ("dropped", "conflict") if on_drift == "refuse" else ()):
            log.warning("field %s: %s (%s -> %s)", r["path"], r["change"], r["old_kind"], r["new_kind"])
    records = crawled.drop("page", "position")
    if failed_pages == "inline":
        records = union_by_name([records, sentinels])
    if rescue_col:
        params.setdefault("drop_subset", fields)
    params.setdefault("rebalance_bronze", True)      # a crawl has few partitions
    p = MedallionParams(root=root, partition_by=partition_by, group_by=group_by,
                        schema=records.schema, casts=casts, table_format=table_format, jdbc=jdbc,
                        **params)
    res = (run_published if publish_runs else run_medallion)(spark, records, p)
    if history:
        history.accept(shape, f"run-{uuid.uuid4().hex[:12]}")
    res.records = crawled
    return res


def record_texts(envelopes: DataFrame) -> DataFrame:
    """``record``: the JSON text of every element of the good pages."""
    body = F.when(F.col("status") == 200, F.col("body"))
    elements = F.when(F.json_array_length(body).isNotNull(),
                      F.from_json(body, T.ArrayType(T.StringType()))).otherwise(F.array(body))
    return envelopes.select(F.explode(elements).alias("record")).filter("record is not null")


def _layers_exist(spark: SparkSession, root: str) -> bool:
    store, root = Store(spark), root.rstrip("/")
    return store.exists(f"{root}/bronze") or store.exists(f"{root}/{POINTER}")


def crawl_order(first: int, last: int):
    """Order columns for crawled records: pages in the order they were
    requested (``first`` towards ``last``), then position within the page."""
    page = F.col("page").desc() if first > last else F.col("page").asc()
    return [page, F.col("position").asc()]
