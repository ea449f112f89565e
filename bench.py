"""Benchmark: headline medallion steps plus every registered query.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 5; the first run is cold, the reported figure is the
median of the warm runs).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = max(2, int(os.environ.get("BENCH_RUNS", "5")))


BASELINE_WARM = {
    "gold_parquet": 0.75,
    "bronze_write": 2.36,
    "bronze_inferred_count": 2.14,
    "bronze_declared_count": 1.11,
    "silver_write": 1.86,
}


def _sf(path: str):
    base = os.path.basename(path)
    base = base[2:] if base.startswith("sf") else base
    try:
        return float(base)
    except ValueError:
        return base


def main() -> None:
    from strata.session import session_conf

    # The engine's single-node profile, with shuffle partitions = cores.
    conf = session_conf("local", with_delta=False)
    conf.update({"spark.sql.shuffle.partitions": str(CPUS), "spark.driver.memory": "16g",
                 "spark.checkpoint.dir": tempfile.mkdtemp(prefix="strata-bench-")})
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("strata-bench")
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    from strata.operators.aggregates import gold_counts
    from strata.plans.medallion import MedallionParams, run_medallion
    from strata.plans.registry import QUERIES
    from strata.session import default_parallelism, scratch_path
    from strata.sinks.files import write_json, write_table
    from strata.sources.files import read_json

    li_path = f"{SF_DIR}/lineitem.parquet"
    # One folder per step for the whole bench; every run overwrites it (the
    # flow's default modes make reruns safe), so disk use does not grow with
    # the number of runs.
    roots = {name: scratch_path(spark, f"bench-{name}")
             for name in ("bronze", "silver", "medallion", "crawl")}
    li_schema = spark.read.parquet(li_path).schema
    keys = ["l_returnflag", "l_linestatus"]
    state: dict[str, str] = {}

    def gold_parquet():
        gold_counts(spark.read.parquet(li_path), keys).collect()

    def bronze_write():
        state["bronze"] = roots["bronze"]
        write_json(spark.read.parquet(li_path), state["bronze"], rebalance=True)   # the table is one file

    def bronze_inferred_count():
        gold_counts(read_json(spark, state["bronze"]), keys).collect()

    def bronze_declared_count():
        gold_counts(read_json(spark, state["bronze"], li_schema), keys).collect()

    def silver_write():
        write_table(read_json(spark, state["bronze"], li_schema), roots["silver"],
                    partition_by=["l_returnflag"], mode="overwrite")

    def medallion_flow():
        p = MedallionParams(root=roots["medallion"],
                            partition_by=["l_returnflag"], group_by=keys, rebalance_bronze=True)
        run_medallion(spark, spark.read.parquet(li_path), p).gold.collect()

    def crawl_flow():
        # The reference's job shape end to end: page bodies crawled by the
        # paged source (file transport, no pacing), routed, flattened, then the
        # medallion flow.  Not part of the headline total.
        from strata.plans.api_job import crawl_records
        from strata.plans.registry import CUSTOMER_PAGE_SCHEMA, PER_PAGE, _write_customer_pages

        if "pages" not in state:
            state["pages"] = _write_customer_pages(spark, SF_DIR)
        url, last_page, per_file = state["pages"]
        records, _ = crawl_records(spark, url, first=last_page, last=1, per_page=PER_PAGE,
                                   concurrency=default_parallelism(spark), pages_per_file=per_file,
                                   record_schema=CUSTOMER_PAGE_SCHEMA, id_field="c_custkey")
        p = MedallionParams(root=roots["crawl"], partition_by=["c_mktsegment"],
                            group_by=["c_mktsegment"], schema=CUSTOMER_PAGE_SCHEMA,
                            rebalance_bronze=True)
        run_medallion(spark, records.drop("page", "position"), p).gold.collect()

    headline = {
        "gold_parquet": gold_parquet,
        "bronze_write": bronze_write,
        "bronze_inferred_count": bronze_inferred_count,
        "bronze_declared_count": bronze_declared_count,
        "silver_write": silver_write,
        "medallion_flow": medallion_flow,
    }
    results: dict[str, float] = {}
    cold: dict[str, float] = {}
    # First pass: JVM start-up and JIT warm-up, reported as "cold".
    for name, fn in headline.items():
        t0 = time.perf_counter()
        fn()
        cold[name] = round(time.perf_counter() - t0, 3)
    for name, fn in headline.items():
        times = []
        for _ in range(RUNS - 1):
            t0 = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)

    times = []
    for _ in range(3):
        t0 = time.perf_counter()
        crawl_flow()
        times.append(time.perf_counter() - t0)
    results["crawl_flow"] = round(statistics.median(times[1:]), 3)

    for name, q in QUERIES.items():
        times = []
        for _ in range(2):
            t0 = time.perf_counter()
            q(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        results[f"q_{name}"] = round(times[-1], 3)

    total = round(sum(results[k] for k in headline), 3)
    print(json.dumps({
        "metric": "medallion_headline_warm_total",
        "value": total,
        "unit": "sec",
        "queries": results,
        "cold": cold,
        "baseline_warm": BASELINE_WARM,
        "speedup_vs_baseline": {k: round(BASELINE_WARM[k] / results[k], 2)
                                for k in BASELINE_WARM if results.get(k)},
        "baseline_steps_total": round(sum(BASELINE_WARM.values()), 3),
        "same_steps_total": round(sum(results[k] for k in BASELINE_WARM), 3),
        "sf": _sf(SF_DIR),
        "cpus": CPUS,
        "runs": RUNS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
