"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables in full.  Queries that write layers put
them in a fresh folder under the shared checkpoint root
(``strata.session.scratch_path``); the returned DataFrame reads them back.
Column names match the DuckDB statements in ``ORACLE_SQL``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.flatten import explode_records, parse_json_column
from strata.functions.paging import on_page, page_of
from strata.operators.aggregates import gold_counts, group_count, partition_counts, top_n
from strata.operators.cleansing import drop_incomplete
from strata.operators.layout import folder_layout
from strata.operators.missing import emptying_columns, missing_costs
from strata.operators.routing import route_pages
from strata.operators.sequence import with_sequence
from strata.operators.union import union_by_name
from strata.operators.vector_topk import top_k
from strata.plans.medallion import MedallionParams, gold_schema, run_medallion
from strata.session import default_parallelism, scratch_path
from strata.sinks.files import OnceLog, append_stamped, publish_single_object, write_json, write_table
from strata.sinks.partition_codec import decoded, encoded
from strata.sources.files import read_json, read_table, read_testdata
from strata.sources.paged_json import page_url, read_pages

PER_PAGE = 200
PAGES_PER_FILE = 16
#: Partition values that a folder name cannot hold as they are, and one that it can.
ODD_VALUES = ["", None, "01", "a/b", "a:b", "~", "~~x", "é %=", "plain"]
GOLD_KEYS = ["c_nationkey", "c_mktsegment"]
CUSTOMER_PAGE_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_mktsegment", T.StringType()),
])


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_testdata(spark, sf_dir, name)


def _customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer records grouped into API-style page bodies (one row per page).

    A page holds the records whose key falls in one block of ``PER_PAGE`` keys,
    so ``collect_list`` per page is bounded by ``PER_PAGE`` rows (keys are unique).
    """
    c = _t(spark, sf_dir, "customer")
    return (c.select(page_of("c_custkey", PER_PAGE).cast("int").alias("page"),
                     F.struct(*CUSTOMER_PAGE_SCHEMA.fieldNames()).alias("rec"))
             .groupBy("page")
             .agg(F.to_json(F.collect_list("rec")).alias("body")))


def _events_with_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with null event_type for errors and NaN value below 10."""
    e = _t(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("event_type"))
         .alias("event_type"),
        F.when(F.col("value") < 10, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
    )


# ---- A1 / O1 / O2 --------------------------------------------------------

def q_gold_two_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + O1: customers per (nation, segment), count descending."""
    return gold_counts(_t(spark, sf_dir, "customer"), GOLD_KEYS)


def q_gold_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + O1 on a second table: orders per (status, priority)."""
    return gold_counts(_t(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


def q_gold_null_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 with a null key (2.8 #14): one segment nulled, its rows form a null group."""
    c = _t(spark, sf_dir, "customer").withColumn(
        "c_mktsegment", F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE")))
    return gold_counts(c, GOLD_KEYS)


def q_preview_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2 / K8: the gold preview, top 20 by count with keys as tie-break."""
    g = group_count(_t(spark, sf_dir, "customer"), GOLD_KEYS)
    return top_n(g, 20, [F.col("count").desc(), F.col("c_nationkey"), F.col("c_mktsegment")])


def q_preview_crawl_head15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: the first 15 records in crawl order (last page first)."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", page_of("c_custkey", PER_PAGE).alias("page"))
    return top_n(c, 15, [F.col("page").desc(), F.col("c_custkey")])


# ---- U1 ------------------------------------------------------------------

def q_crawl_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0-based crawl position of every record (distributed sequence)."""
    c = _t(spark, sf_dir, "customer").select("c_custkey")
    order = [page_of("c_custkey", PER_PAGE).desc(), F.col("c_custkey").asc()]
    # the session's shuffle partitions, more where a task would sort over ~2M rows
    return with_sequence(c, order, "seq", rows_per_partition=2_000_000).select("c_custkey", "seq")


def _with_stray_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    page3 = on_page("c_custkey", 3, PER_PAGE)
    stray = base.filter(page3).withColumn("extra", F.lit("x"))
    return union_by_name([base.filter(~page3), stray])


def q_stray_column_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 + P3 (2.8 #1): a column only page 3 has empties every other page."""
    return drop_incomplete(_with_stray_column(spark, sf_dir))


def q_page_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with and without a column, unioned by name (missing -> null)."""
    n = _t(spark, sf_dir, "nation")
    full = n.filter(F.col("n_nationkey") % 2 == 0)
    short = n.filter(F.col("n_nationkey") % 2 == 1).drop("n_regionkey")
    return union_by_name([full, short]).select("n_nationkey", "n_name", "n_regionkey")


# ---- P3 ------------------------------------------------------------------

def q_drop_any_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a null or NaN in any column are dropped."""
    return drop_incomplete(_events_with_missing(spark, sf_dir))


def q_drop_null_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 with a subset: only nulls in event_type drop a row."""
    return drop_incomplete(_events_with_missing(spark, sf_dir), subset=["event_type"]).select("event_id")


# ---- P1 ------------------------------------------------------------------

def q_json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON text column parsed with a declared schema and flattened."""
    e = _t(spark, sf_dir, "events")
    return parse_json_column(e, "props", "k BIGINT", sep="_", keep=["event_id"])


def q_page_bodies_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page bodies (JSON arrays) exploded back into flat records."""
    pages = _customer_pages(spark, sf_dir)
    return explode_records(pages, "body", CUSTOMER_PAGE_SCHEMA).select(
        "c_custkey", "c_name", "c_mktsegment")


# ---- S1 / P4 -------------------------------------------------------------

def q_paged_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + F3: page bodies written as files, crawled back with the paged source."""
    url, last_page, per_file = _write_customer_pages(spark, sf_dir)
    # File transport: one task per core is enough (an HTTP crawl would size
    # concurrency by the API's allowed request rate instead).
    tasks = min(last_page, default_parallelism(spark))
    env = read_pages(spark, url, first=last_page, last=1,
                     per_page=PER_PAGE, concurrency=tasks, pages_per_file=per_file)
    records, _failed = route_pages(env, CUSTOMER_PAGE_SCHEMA, id_field="c_custkey")
    return group_count(records, ["page"])


def q_single_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page fetched by its number, the last one; its records."""
    url, last_page, per_file = _write_customer_pages(spark, sf_dir)
    env = read_pages(spark, url, first=last_page, last=last_page, per_page=PER_PAGE, pages_per_file=per_file)
    records, _failed = route_pages(env, CUSTOMER_PAGE_SCHEMA, id_field="c_custkey")
    return records.select("c_custkey", "c_name", "c_mktsegment")


def q_paced_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the crawl under one request schedule for all its tasks; records per page."""
    url, last_page, per_file = _write_customer_pages(spark, sf_dir)
    env = read_pages(spark, url, first=1, last=last_page, per_page=PER_PAGE, concurrency=min(4, last_page),
                     requests_per_second=500, pages_per_file=per_file)
    records, _failed = route_pages(env, CUSTOMER_PAGE_SCHEMA, id_field="c_custkey")
    return group_count(records, ["page"])


def q_refused_crawl_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a crawl with a lost page ends loud and leaves the layers of the run before as they were."""
    from strata.plans.api_job import run_api_medallion

    url, last_page, per_file = _write_customer_pages(spark, sf_dir)
    first_page = int(_t(spark, sf_dir, "customer").agg(F.min(page_of("c_custkey", PER_PAGE))).first()[0] or 1)
    job = dict(last=first_page, per_page=PER_PAGE, pause_seconds=0, record_schema=CUSTOMER_PAGE_SCHEMA,
               id_field="c_custkey", partition_by=["c_mktsegment"], group_by=["c_mktsegment"], pages_per_file=per_file,
               concurrency=min(last_page, default_parallelism(spark)))
    root = scratch_path(spark, "refused-crawl")
    good = run_api_medallion(spark, url, root, first=last_page, **job)
    try:
        run_api_medallion(spark, url, root, first=last_page + PAGES_PER_FILE, **job)      # pages that are not there
    except RuntimeError:
        return good.gold
    raise AssertionError("the second crawl was meant to fail")


def q_page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S5: the same pages read by Spark's own file systems (its endpoint and keys)."""
    from strata.sources.page_files import read_page_files

    url, last_page, per_file = _write_customer_pages(spark, sf_dir)
    env = read_page_files(spark, url, first=last_page, last=1, per_page=PER_PAGE, pages_per_file=per_file)
    records, _failed = route_pages(env, CUSTOMER_PAGE_SCHEMA, id_field="c_custkey")
    return group_count(records, ["page"])


def q_crawl_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 as a checkpointed stream: a crawl that is stopped after its first pages and taken up
    over the whole range, in which every page is asked for once."""
    from strata.streaming.crawl_stream import CrawlStore

    url, last_page, per_file = _write_customer_pages(spark, sf_dir)
    crawl = CrawlStore(spark, scratch_path(spark, "crawl-store"), url, PER_PAGE, per_file)
    tasks = min(last_page, default_parallelism(spark))
    batch = max(per_file * tasks, -(-last_page // 2))
    crawl.run(last_page, last_page // 2 + 1, batch, concurrency=tasks)
    crawl.run(last_page, 1, batch, concurrency=tasks)
    records, _failed = route_pages(crawl.pages(last_page, 1), CUSTOMER_PAGE_SCHEMA, id_field="c_custkey")
    asked = group_count(crawl.requests(), ["page"], "n_requests")
    return group_count(records, ["page"], "n_records").join(asked, "page")


def q_failed_page_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed pages (status 500) become sentinel rows with id = url."""
    pages = _customer_pages(spark, sf_dir)
    env = pages.select(
        "page",
        F.concat(F.lit("page="), F.col("page").cast("string")).alias("url"),
        F.when(F.col("page") % 3 == 0, F.lit(500)).otherwise(F.lit(200)).alias("status"),
        "body")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])
    _records, sentinels = route_pages(env, schema, id_field="id")
    return sentinels


# ---- K1 / S3 / K2 / F2 / K7 ----------------------------------------------

def q_bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + S3: events through bronze JSON and back, lossless (2.8 #6-#8)."""
    e = _t(spark, sf_dir, "events")
    path = scratch_path(spark, "bronze-events")
    write_json(e, path)
    return read_json(spark, path, e.schema)


def q_bronze_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 with inference: int columns come back as bigint (2.8 #7)."""
    li = _t(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "bronze-lineitem")
    write_json(li, path)
    return read_json(spark, path).select("l_extendedprice", "l_linenumber", "l_orderkey")


def q_silver_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: partitioned silver read with a filter on the partition column (pruned)."""
    e = _t(spark, sf_dir, "events")
    path = scratch_path(spark, "silver-events")
    write_table(e, path, partition_by=["event_type"], mode="overwrite")
    s = read_table(spark, path, schema=e.schema)
    return s.filter(F.col("event_type") == "error").select("event_id", "user_id")


def q_silver_dynamic_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a rerun replaces only the partitions it writes (dynamic overwrite)."""
    e = _t(spark, sf_dir, "events")
    path = scratch_path(spark, "silver-rerun")
    write_table(e, path, partition_by=["event_type"], mode="overwrite")
    again = e.filter((F.col("event_type") == "error") & (F.col("event_id") % 2 == 0))
    write_table(again, path, partition_by=["event_type"], mode="overwrite", dynamic_overwrite=True)
    return group_count(read_table(spark, path, schema=e.schema), ["event_type"])


def q_single_object_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: gold published as one object, read back with its schema."""
    gold = q_gold_two_key_count(spark, sf_dir)
    path = scratch_path(spark, "gold-object")
    publish_single_object(gold, path, fmt="json", object_name="gold.json")
    c = _t(spark, sf_dir, "customer")
    return read_json(spark, path, gold_schema(c.schema, GOLD_KEYS))


def q_table_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4's replace semantics on a file table: written twice, read once."""
    c = _t(spark, sf_dir, "customer")
    path = scratch_path(spark, "replace")
    write_table(c, path, mode="overwrite")
    write_table(c, path, mode="overwrite")
    return read_table(spark, path, schema=c.schema)


def q_table_append_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 + K6 on a file table with a bounded string and a column default: create
    if absent (twice), append nation by the default and by the stamping sink."""
    import uuid

    n = _t(spark, sf_dir, "nation")
    path = scratch_path(spark, "append-log")
    name = "strata_log_" + uuid.uuid4().hex[:12]
    kinds = {f.name: f.dataType.simpleString() for f in n.schema.fields}
    ddl = (f"CREATE TABLE IF NOT EXISTS {name} (n_nationkey {kinds['n_nationkey']}, n_name VARCHAR(255), "
           f"n_regionkey {kinds['n_regionkey']}, timestamp TIMESTAMP DEFAULT current_timestamp()) "
           f"USING parquet LOCATION '{path}'")
    spark.sql(ddl)
    spark.sql(ddl)
    cols = ["n_nationkey", "n_name", "n_regionkey"]
    spark.sql(f"INSERT INTO {name} ({', '.join(cols)}) SELECT {', '.join(cols)} FROM {{n}}", n=n)
    spark.sql(f"DROP TABLE {name}")          # external table: the data stays
    append_stamped(n.select(cols), path)
    log = spark.read.parquet(path)
    return log.groupBy(cols).agg(F.count(F.lit(1)).alias("n"), F.count("timestamp").alias("n_stamped"))


# ---- F1 ------------------------------------------------------------------

def q_medallion_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer through bronze, silver and gold; gold read back."""
    c = _t(spark, sf_dir, "customer")
    p = MedallionParams(root=scratch_path(spark, "medallion"), partition_by=["c_mktsegment"],
                        group_by=GOLD_KEYS)
    return run_medallion(spark, c, p).gold


def q_medallion_layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the per-layer row counts observed while the flow wrote its layers."""
    c = _t(spark, sf_dir, "customer")
    p = MedallionParams(root=scratch_path(spark, "medallion-counts"), partition_by=["c_mktsegment"],
                        group_by=GOLD_KEYS)
    counts = run_medallion(spark, c, p).counts
    # three rows, one per layer, built from the observed metrics
    return spark.createDataFrame(list(counts.items()), "layer string, rows bigint")


def _write_customer_pages(spark: SparkSession, sf_dir: str) -> tuple[str, int, int]:
    """(URL template, last page, pages per file): bodies stored grouped, one line per page."""
    pages = _customer_pages(spark, sf_dir)
    root = scratch_path(spark, "pages")
    chunk = F.floor(F.col("page") / PAGES_PER_FILE).cast("int")
    (pages.select(chunk.alias("chunk"), F.to_json(F.struct("page", "body")).alias("value"))
     .repartition("chunk").write.partitionBy("chunk").text(root))
    # Page count from the key range: a one-column aggregate, not a second pass
    # over the page bodies.
    max_key = _t(spark, sf_dir, "customer").agg(F.max("c_custkey")).first()[0]
    last = 1 if max_key is None else int(max_key) // PER_PAGE + 1
    return page_url(root, "chunk"), last, PAGES_PER_FILE


def q_crawl_medallion_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + P4 + P1 + F1, the whole job: crawl once, route, flatten, bronze/silver/gold."""
    from strata.plans.api_job import run_api_medallion

    url, last_page, per_file = _write_customer_pages(spark, sf_dir)
    first_page = _t(spark, sf_dir, "customer").agg(F.min(page_of("c_custkey", PER_PAGE))).first()[0] or 1
    return run_api_medallion(spark, url, scratch_path(spark, "crawl-medallion"),
                             first=last_page, last=int(first_page), per_page=PER_PAGE, pause_seconds=0,
                             concurrency=min(last_page, default_parallelism(spark)),
                             record_schema=CUSTOMER_PAGE_SCHEMA, id_field="c_custkey",
                             partition_by=["c_mktsegment"], group_by=["c_mktsegment"],
                             pages_per_file=per_file).gold


def q_published_rerun_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 + F2, published at once: a run, then one that fails after its bronze; readers still see the first."""
    from strata.plans.publish import open_layers, run_published

    c = _t(spark, sf_dir, "customer")
    p = MedallionParams(root=scratch_path(spark, "published"), partition_by=["c_mktsegment"], group_by=GOLD_KEYS)
    run_published(spark, c, p)
    broken = replace(p, casts={"no_such_column": "int"})         # found out at silver
    try:
        run_published(spark, c.filter(F.col("c_custkey") % 2 == 0), broken)
    except ValueError:
        return open_layers(spark, p, c.schema)["gold"]
    raise AssertionError("the second run was meant to fail")


def q_maintained_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 + A1: gold kept by signed counts over three batches: a load whose FURNITURE rows have the
    wrong nation, the same batch again, and a correction of that one partition."""
    from strata.plans.maintained_gold import MaintainedGold

    c = _t(spark, sf_dir, "customer")
    gold = MaintainedGold(spark, scratch_path(spark, "maintained"), c.schema, ["c_mktsegment"], GOLD_KEYS)
    furniture = F.col("c_mktsegment") == "FURNITURE"
    wrong = c.withColumn("c_nationkey", F.when(furniture, F.lit(-1)).otherwise(F.col("c_nationkey")).cast("int"))
    gold.apply("load", wrong)
    gold.apply("load", wrong)
    gold.apply("correct-furniture", c.filter(furniture))
    return gold.gold()


def q_partition_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 with values that folder names cannot hold as they are (2.8 #9-#10): events by an empty,
    a missing, a zero-led and a special text, written partitioned and read back by a pruned filter."""
    e = _odd_events(spark, sf_dir)
    path = scratch_path(spark, "odd-partitions")
    write_table(encoded(e, ["kind"]), path, partition_by=["kind"], mode="overwrite")
    back = decoded(read_table(spark, path, schema=e.schema), ["kind"])
    return back.filter((F.col("kind") != "plain") | F.col("kind").isNull()).select("event_id", "kind")


def _odd_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.element_at(F.array(*[F.lit(v) for v in ODD_VALUES]), (F.col("event_id") % len(ODD_VALUES) + 1).cast("int"))
    return _t(spark, sf_dir, "events").select("event_id", odd.alias("kind"))


def q_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 + P1 between runs (2.8 #1, #6-#7): fields of the event records that were added, dropped,
    widened or came into conflict since the run before, from the stored profile."""
    from strata.plans.drift import SchemaHistory, drift, profile

    e = _t(spark, sf_dir, "events")
    before = e.select(F.to_json(F.struct("event_id", "user_id", F.floor("value").alias("value"), "event_type"))
                      .alias("record"))
    after = e.select(F.to_json(F.struct("event_id", F.concat(F.lit("u"), "user_id").alias("user_id"),
                                        (F.floor("value") + 0.5).cast("double").alias("value"),
                                        F.struct(F.col("event_type").alias("kind")).alias("detail"))).alias("record"))
    history = SchemaHistory(spark, scratch_path(spark, "drift"))
    history.accept(profile(before), "run-1")
    return drift(history.last(), profile(after)).select("path", "change", "old_kind", "new_kind")


def q_missing_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 explained (2.8 #1): what each column of events costs in rows."""
    return missing_costs(_events_with_missing(spark, sf_dir))


def q_stray_column_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 explained: the column that empties the union of ``stray_column_drop`` is named."""
    return emptying_columns(_with_stray_column(spark, sf_dir)).select("column", "n_alone", "n_lost", "n_rows")


def q_silver_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + K2: rows per folder of a written silver, from the files that hold them."""
    e = _t(spark, sf_dir, "events")
    path = scratch_path(spark, "silver-layout")
    write_table(e, path, partition_by=["event_type"], mode="overwrite")
    layout = folder_layout(read_table(spark, path, schema=e.schema))
    return layout.select(F.substring_index("folder", "=", -1).alias("event_type"), "rows",
                         (F.col("files") > 0).alias("has_files"))


def q_log_append_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 + F4: a stamped append by batch name; one batch is sent twice, one was cut short before its commit."""
    n = _t(spark, sf_dir, "nation")
    log = OnceLog(spark, scratch_path(spark, "once-log"))
    log.append(n, "first")
    log.append(n, "first")
    log.write(n.filter("n_nationkey < 3"), "second")             # cut short: rows without a commit
    log.append(n, "second")
    return (log.read(n.schema).groupBy("n_nationkey", "n_name", "batch")
            .agg(F.count(F.lit(1)).alias("n"), F.count("timestamp").alias("n_stamped")))


def q_vector_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five likest vectors of every vector, exactly."""
    v = _t(spark, sf_dir, "embeddings")
    return top_k(v, v, 5).select("query", "rank", "id")


def q_nested_medallion_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + P3 + F1 on nested records: orders as JSON objects that hold status and
    priority in a struct, flattened to dotted columns, through bronze, silver
    (partitioned on a dotted column) and gold (grouped on dotted keys)."""
    o = _t(spark, sf_dir, "orders")
    state = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    bodies = o.select(F.to_json(F.struct("o_orderkey", state.alias("state"))).alias("body"))
    schema = T.StructType([
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("state", T.StructType([T.StructField("status", T.StringType()),
                                             T.StructField("priority", T.StringType())])),
    ])
    records = explode_records(bodies, "body", schema)
    p = MedallionParams(root=scratch_path(spark, "nested-medallion"), partition_by=["state.status"],
                        group_by=["state.status", "state.priority"])
    return run_medallion(spark, records, p).gold.toDF("o_orderstatus", "o_orderpriority", "count")


def q_medallion_incremental_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 as an incremental streaming run over the customer table's files."""
    from strata.streaming.incremental import run_incremental_medallion

    c = _t(spark, sf_dir, "customer")
    p = MedallionParams(root=scratch_path(spark, "incremental"), partition_by=["c_mktsegment"],
                        group_by=GOLD_KEYS, schema=c.schema)
    src = f"{sf_dir.rstrip('/')}/{{customer.parquet}}"      # a glob of one name: a file or a folder
    return run_incremental_medallion(spark, src, "parquet", p).gold


# ---- S4 / P2 / A2 --------------------------------------------------------

def q_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 + A2: lineitem dealt to partitions by a known rule, and its rows per physical partition."""
    dealt = _t(spark, sf_dir, "lineitem").repartitionById(7, (F.col("l_orderkey") % 7).cast("int"))
    return partition_counts(dealt)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "gold_two_key_count": q_gold_two_key_count,
    "gold_orders": q_gold_orders,
    "medallion_gold": q_medallion_gold,
    "medallion_incremental_gold": q_medallion_incremental_gold,
    "medallion_layer_counts": q_medallion_layer_counts,
    "crawl_medallion_gold": q_crawl_medallion_gold,
    "nested_medallion_gold": q_nested_medallion_gold,
    "gold_null_group": q_gold_null_group,
    "preview_top20": q_preview_top20,
    "preview_crawl_head15": q_preview_crawl_head15,
    "crawl_sequence": q_crawl_sequence,
    "drop_any_null": q_drop_any_null,
    "drop_null_subset": q_drop_null_subset,
    "stray_column_drop": q_stray_column_drop,
    "page_union_by_name": q_page_union_by_name,
    "json_flatten": q_json_flatten,
    "page_bodies_explode": q_page_bodies_explode,
    "paged_source": q_paged_source,
    "failed_page_audit": q_failed_page_audit,
    "bronze_roundtrip": q_bronze_roundtrip,
    "bronze_inferred": q_bronze_inferred,
    "silver_pruned": q_silver_pruned,
    "silver_dynamic_rerun": q_silver_dynamic_rerun,
    "single_object_publish": q_single_object_publish,
    "table_replace": q_table_replace,
    "table_append_stamped": q_table_append_stamped,
    "partition_counts": q_partition_counts,
    "published_rerun_gold": q_published_rerun_gold,
    "maintained_gold": q_maintained_gold,
    "crawl_resumed": q_crawl_resumed,
    "page_files": q_page_files,
    "single_page": q_single_page,
    "paced_crawl": q_paced_crawl,
    "refused_crawl_gold": q_refused_crawl_gold,
    "partition_values": q_partition_values,
    "schema_drift": q_schema_drift,
    "missing_costs": q_missing_costs,
    "stray_column_named": q_stray_column_named,
    "silver_layout": q_silver_layout,
    "log_append_once": q_log_append_once,
    "vector_top_k": q_vector_top_k,
}

_GOLD_SQL = ('SELECT c_nationkey, c_mktsegment, count(*) AS "count" '
             'FROM customer GROUP BY 1, 2')

ORACLE_SQL: dict[str, str] = {
    "gold_two_key_count": _GOLD_SQL,
    "gold_orders": ('SELECT o_orderstatus, o_orderpriority, count(*) AS "count" '
                    'FROM orders GROUP BY 1, 2'),
    "medallion_gold": _GOLD_SQL,
    "medallion_incremental_gold": _GOLD_SQL,
    "medallion_layer_counts": ("SELECT 'bronze' AS layer, count(*) AS \"rows\" FROM customer "
                               "UNION ALL SELECT 'silver', count(*) FROM customer "
                               "UNION ALL SELECT 'gold', count(*) FROM "
                               "(SELECT DISTINCT c_nationkey, c_mktsegment FROM customer)"),
    "crawl_medallion_gold": 'SELECT c_mktsegment, count(*) AS "count" FROM customer GROUP BY 1',
    "nested_medallion_gold": ('SELECT o_orderstatus, o_orderpriority, count(*) AS "count" '
                              'FROM orders WHERE o_orderstatus IS NOT NULL AND '
                              'o_orderpriority IS NOT NULL GROUP BY 1, 2'),
    "gold_null_group": ("SELECT c_nationkey, nullif(c_mktsegment, 'FURNITURE') AS c_mktsegment, "
                        'count(*) AS "count" FROM customer GROUP BY 1, 2'),
    "preview_top20": _GOLD_SQL + " ORDER BY 3 DESC, 1, 2 LIMIT 20",
    "preview_crawl_head15": ("SELECT c_custkey, c_custkey // 200 + 1 AS page FROM customer "
                             "ORDER BY 2 DESC, 1 LIMIT 15"),
    "crawl_sequence": ("SELECT c_custkey, row_number() OVER "
                       "(ORDER BY c_custkey // 200 DESC, c_custkey) - 1 AS seq FROM customer"),
    "drop_any_null": ("SELECT event_id, event_type, value FROM events "
                      "WHERE event_type <> 'error' AND value >= 10"),
    "drop_null_subset": "SELECT event_id FROM events WHERE event_type <> 'error'",
    "stray_column_drop": ("SELECT c_custkey, c_name, 'x' AS extra FROM customer "
                          "WHERE c_custkey // 200 + 1 = 3"),
    "page_union_by_name": ("SELECT n_nationkey, n_name, CASE WHEN n_nationkey % 2 = 0 "
                           "THEN n_regionkey END AS n_regionkey FROM nation"),
    "json_flatten": ("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k "
                     "FROM events"),
    "page_bodies_explode": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "paged_source": ('SELECT CAST(c_custkey // 200 + 1 AS INTEGER) AS page, count(*) AS "count" '
                     "FROM customer GROUP BY 1"),
    "failed_page_audit": ("SELECT DISTINCT concat('page=', c_custkey // 200 + 1) AS id, "
                          "CAST(NULL AS VARCHAR) AS name FROM customer "
                          "WHERE (c_custkey // 200 + 1) % 3 = 0"),
    "bronze_roundtrip": "SELECT * FROM events",
    "bronze_inferred": ("SELECT l_extendedprice, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
                        "l_orderkey FROM lineitem"),
    "silver_pruned": "SELECT event_id, user_id FROM events WHERE event_type = 'error'",
    "silver_dynamic_rerun": ('SELECT event_type, count(*) AS "count" FROM events '
                             "WHERE event_type <> 'error' OR event_id % 2 = 0 GROUP BY 1"),
    "single_object_publish": _GOLD_SQL,
    "table_replace": "SELECT * FROM customer",
    "table_append_stamped": ("SELECT n_nationkey, n_name, n_regionkey, CAST(2 AS BIGINT) AS n, "
                             "CAST(2 AS BIGINT) AS n_stamped FROM nation"),
    "partition_counts": ('SELECT CAST(l_orderkey % 7 AS INTEGER) AS partition, count(*) AS "count" '
                         "FROM lineitem GROUP BY 1"),
    "published_rerun_gold": _GOLD_SQL,
    "maintained_gold": _GOLD_SQL,
    "crawl_resumed": ("SELECT CAST(c_custkey // 200 + 1 AS INTEGER) AS page, count(*) AS n_records, "
                      "CAST(1 AS BIGINT) AS n_requests FROM customer GROUP BY 1"),
    "page_files": ('SELECT CAST(c_custkey // 200 + 1 AS INTEGER) AS page, count(*) AS "count" '
                   "FROM customer GROUP BY 1"),
    "single_page": ("SELECT c_custkey, c_name, c_mktsegment FROM customer "
                    "WHERE c_custkey // 200 = (SELECT max(c_custkey) // 200 FROM customer)"),
    "paced_crawl": ('SELECT CAST(c_custkey // 200 + 1 AS INTEGER) AS page, count(*) AS "count" '
                    "FROM customer GROUP BY 1"),
    "refused_crawl_gold": 'SELECT c_mktsegment, count(*) AS "count" FROM customer GROUP BY 1',
    "partition_values": ("SELECT event_id, kind FROM (SELECT event_id, list_extract(['', NULL, '01', 'a/b', "
                         "'a:b', '~', '~~x', 'é %=', 'plain'], event_id % 9 + 1) AS kind FROM events) "
                         "WHERE kind IS DISTINCT FROM 'plain'"),
    "schema_drift": ("SELECT * FROM (VALUES ('detail', 'added', NULL, 'object'), ('detail.kind', 'added', NULL, "
                     "'string'), ('event_type', 'dropped', 'string', NULL), ('user_id', 'conflict', 'long', 'string'), "
                     "('value', 'widened', 'long', 'decimal')) t(path, change, old_kind, new_kind) "
                     "WHERE EXISTS (SELECT 1 FROM events)"),
    "missing_costs": """
        WITH t AS (SELECT event_id IS NULL AS a, event_type IS NULL OR event_type = 'error' AS b, value < 10 AS c
                   FROM events)
        SELECT 'event_id' AS "column", count(*) FILTER (a) AS n_missing, count(*) FILTER (a AND NOT b AND NOT c) AS n_alone,
               count(*) FILTER (a OR b OR c) AS n_lost, count(*) AS n_rows FROM t
        UNION ALL SELECT 'event_type', count(*) FILTER (b), count(*) FILTER (b AND NOT a AND NOT c),
               count(*) FILTER (a OR b OR c), count(*) FROM t
        UNION ALL SELECT 'value', count(*) FILTER (c), count(*) FILTER (c AND NOT a AND NOT b),
               count(*) FILTER (a OR b OR c), count(*) FROM t""",
    "stray_column_named": ("SELECT 'extra' AS \"column\", count(*) FILTER (c_custkey // 200 + 1 <> 3) AS n_alone, "
                           "count(*) FILTER (c_custkey // 200 + 1 <> 3) AS n_lost, count(*) AS n_rows FROM customer"),
    "silver_layout": ('SELECT event_type, count(*) AS "rows", true AS has_files FROM events GROUP BY 1'),
    "log_append_once": ("SELECT n_nationkey, n_name, batch, CAST(1 AS BIGINT) AS n, CAST(1 AS BIGINT) AS n_stamped "
                        "FROM nation, (VALUES ('first'), ('second')) b(batch)"),
    "vector_top_k": """
        WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        s AS (SELECT a.vec_id AS query, b.vec_id AS id, round(list_cosine_similarity(a.e, b.e), 9) AS score
              FROM v a, v b WHERE a.vec_id <> b.vec_id),
        r AS (SELECT query, id, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS INTEGER) AS rank
              FROM s)
        SELECT query, rank, id FROM r WHERE rank <= 5""",
}
