"""Command line: the whole job (F5 parameters as flags) and the distribution check.

    spark-submit strata/cli.py medallion \
        --url 'https://api.example/items?page={page}&per_page={per_page}' \
        --root s3a://lake/items --endpoint http://store:9000 --first 40 --last 1
    spark-submit strata/cli.py partitions --rows 10000 --partitions 4
    spark-submit strata/cli.py partitions --table s3a://lake/items/silver

Object-store keys come from ``AWS_ACCESS_KEY_ID`` / ``AWS_SECRET_ACCESS_KEY``;
JDBC credentials from the environment variables named by ``--jdbc-user-env`` /
``--jdbc-password-env``.  Nothing secret is accepted on the command line.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    top = argparse.ArgumentParser(description="strata jobs")
    sub = top.add_subparsers(dest="command", required=True)
    pc = sub.add_parser("partitions", help="rows per partition (distribution check)")
    pc.add_argument("--rows", type=int, default=10000, help="range size when no --table")
    pc.add_argument("--partitions", type=int, default=4)
    pc.add_argument("--table", help="table folder: rows per physical partition of its scan")
    pc.add_argument("--format", default="parquet")
    ap = sub.add_parser("medallion", help="crawl a paged JSON API into bronze/silver/gold")
    ap.add_argument("--url", required=True, help="page URL template with {page} and {per_page}")
    ap.add_argument("--root", required=True, help="storage root for the layers")
    ap.add_argument("--first", type=int, default=40)
    ap.add_argument("--last", type=int, default=1)
    ap.add_argument("--per-page", type=int, default=200)
    ap.add_argument("--pause-seconds", type=float, default=1.0)
    ap.add_argument("--concurrency", type=int, default=1)
    ap.add_argument("--format", default="parquet", help="silver/gold table format (delta when present)")
    ap.add_argument("--failed-pages", choices=["audit", "inline", "drop"], default="audit")
    ap.add_argument("--drop-incomplete-at", choices=["bronze", "silver", "none"], default="bronze")
    ap.add_argument("--silver-mode", default="overwrite")
    ap.add_argument("--gold-mode", default="overwrite")
    ap.add_argument("--allow-incomplete", action="store_true",
                    help="go on although some pages could not be fetched or parsed")
    ap.add_argument("--allow-empty", action="store_true", help="let a crawl without records empty existing layers")
    ap.add_argument("--store", help="folder that keeps the fetched pages, so that a stopped crawl is taken up")
    ap.add_argument("--requests-per-second", type=float, default=0.0, help="one request schedule for all tasks")
    ap.add_argument("--publish-runs", action="store_true", help="write run folders and swap one pointer")
    ap.add_argument("--on-drift", choices=["report", "refuse"], help="compare the records' fields with the last run")
    schema = ap.add_mutually_exclusive_group()
    schema.add_argument("--record-schema", help="record schema as DDL (default: the brewery record)")
    schema.add_argument("--infer-schema", action="store_true", help="infer the record schema from all pages")
    ap.add_argument("--id-field", default="id", help="field that holds the URL in a failed page's row")
    ap.add_argument("--partition-by", nargs="+", help="silver partition columns")
    ap.add_argument("--group-by", nargs="+", help="gold grouping columns")
    ap.add_argument("--cast", nargs="*", metavar="COLUMN:TYPE", help="silver types of text columns")
    ap.add_argument("--serving-layer", choices=["silver", "gold"], default="silver")
    ap.add_argument("--jdbc-partitions", type=int, default=8, help="concurrent JDBC connections")
    ap.add_argument("--rescue-col", help="keep unknown record keys as JSON text in this column")
    ap.add_argument("--endpoint", help="S3-compatible endpoint for s3a:// roots")
    ap.add_argument("--jdbc-url")
    ap.add_argument("--jdbc-table")
    ap.add_argument("--jdbc-driver")
    ap.add_argument("--jdbc-user-env")
    ap.add_argument("--jdbc-password-env")
    ap.add_argument("--jdbc-truncate", action="store_true")
    ap.add_argument("--preview", type=int, default=20, help="gold rows to print (0: none)")
    ap.add_argument("--preview-crawl", type=int, default=15,
                    help="first crawled records to print, in crawl order (0: none)")
    return top.parse_args(argv)


def _partitions(spark, a) -> list[tuple[int, int]]:
    from strata.operators.aggregates import partition_counts
    from strata.sources.generators import range_frame

    df = partition_counts(spark.read.format(a.format).load(a.table) if a.table
                          else range_frame(spark, 0, a.rows, 1, a.partitions))
    counts = [tuple(r) for r in df.orderBy("partition").collect()]      # one row per task
    for partition, n in counts:
        print(f"{partition}\t{n}")
    return counts


def main(argv: list[str] | None = None):
    a = parse_args(argv)
    from pyspark.sql import SparkSession

    from strata.plans.api_job import run_api_medallion
    from strata.session import apply_object_store_conf, object_store_conf, session_conf

    active = SparkSession.getActiveSession()
    if active is not None:
        spark, owned = active, False
    else:
        builder = SparkSession.builder.appName("strata-api-medallion")
        for k, v in session_conf("cluster").items():
            builder = builder.config(k, v)
        spark, owned = builder.getOrCreate(), True
    try:
        if a.command == "partitions":
            return _partitions(spark, a)
        if a.endpoint:
            apply_object_store_conf(spark, object_store_conf(a.endpoint))
        jdbc = None
        if a.jdbc_url and a.jdbc_table:
            jdbc = {"url": a.jdbc_url, "table": a.jdbc_table, "driver": a.jdbc_driver,
                    "user_env": a.jdbc_user_env, "password_env": a.jdbc_password_env,
                    "truncate": a.jdbc_truncate, "num_partitions": a.jdbc_partitions}
        record = {}
        if a.record_schema or a.infer_schema:
            record["record_schema"] = a.record_schema
        if a.cast is not None:
            record["casts"] = dict(c.rsplit(":", 1) for c in a.cast)
        res = run_api_medallion(
            spark, a.url, a.root, first=a.first, last=a.last, per_page=a.per_page,
            pause_seconds=a.pause_seconds, concurrency=a.concurrency,
            failed_pages=a.failed_pages, table_format=a.format, jdbc=jdbc,
            rescue_col=a.rescue_col, allow_incomplete=a.allow_incomplete, allow_empty=a.allow_empty,
            store=a.store, requests_per_second=a.requests_per_second, publish_runs=a.publish_runs,
            on_drift=a.on_drift, id_field=a.id_field,
            partition_by=a.partition_by, group_by=a.group_by, serving_layer=a.serving_layer, **record,
            drop_incomplete_at=None if a.drop_incomplete_at == "none" else a.drop_incomplete_at,
            silver_mode=a.silver_mode, gold_mode=a.gold_mode)
        print(json.dumps({"counts": res.counts}))
        if a.preview_crawl and res.records is not None:
            from strata.plans.api_job import crawl_order
            from strata.sinks.console import show_preview

            show_preview(res.records, a.preview_crawl, crawl_order(a.first, a.last))
        if a.preview:
            res.gold.show(a.preview, truncate=False)
        return res.counts
    finally:
        if owned:
            spark.stop()


if __name__ == "__main__":
    main()
