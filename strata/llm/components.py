"""Connected components of a link table, by alternating stars.

In each turn every node first ties its larger neighbours to the smallest node
it knows, then its smaller ones (and itself) likewise, until nothing changes;
the number of turns grows with the logarithm of the longest chain.  All steps
are aggregates and joins; each turn's links are stored, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.blocks import stored


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component_id) of every node of ``links`` (a, b); the component's smallest id names it."""
    now = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .distinct(), "links")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("v").alias("id")).distinct()
    return (now.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
            .unionByName(roots.select("id", F.col("id").alias("component_id"))))
