"""Run by test_fault_tolerance.py in its own Spark process with task retries."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _failing_once(marker: str):
    def fail_first_attempt(batches):
        for pdf in batches:
            if not os.path.exists(marker):
                open(marker, "w").close()
                raise RuntimeError("injected task failure")
            yield pdf
    return fail_first_attempt


def main(mode: str, root: str, marker: str) -> None:
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[2,4]")      # up to 4 attempts per task
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    if mode == "crawl":
        from strata.sources.paged_json import page_url, read_pages

        env = read_pages(spark, page_url(root), first=6, last=1, concurrency=2)
        rows = env.mapInPandas(_failing_once(marker), env.schema).collect()
        print("PAGES", sorted(r.page for r in rows))
    else:
        from strata.plans.medallion import MedallionParams, run_medallion

        src = spark.range(0, 3000, 1, 3).selectExpr("id", "CAST(id % 7 AS STRING) AS g")
        src = src.mapInPandas(_failing_once(marker), src.schema)
        p = MedallionParams(root=root, partition_by=["g"], group_by=["g"])
        res = run_medallion(spark, src, p)
        print("COUNTS", res.counts["bronze"], res.counts["silver"], res.counts["gold"],
              res.gold.groupBy().sum("count").first()[0])
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], sys.argv[3])
