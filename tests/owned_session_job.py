"""Run by test_fault_tolerance.py: the job wrapper creates, uses and stops its own session."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(root: str) -> None:
    from pyspark.sql import SparkSession

    from strata.plans.medallion import MedallionParams, medallion_job

    p = MedallionParams(root=root, partition_by=["g"], group_by=["g"])
    res = medallion_job(lambda s: s.range(0, 300, 1, 2).selectExpr("id", "CAST(id % 3 AS STRING) AS g"), p)
    print("COUNTS", res.counts["bronze"], res.counts["silver"], res.counts["gold"])
    print("STOPPED", SparkSession.getActiveSession() is None)


if __name__ == "__main__":
    main(sys.argv[1])
