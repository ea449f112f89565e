"""Schema drift between crawls: a mergeable profile of the records, compared per run.

A profile has one row per (field path, kind): in how many records the path has a
value of that kind.  Records are first counted by shape (their schema as text), one
aggregate with map-side combine over the records' JSON text; the fields are then
taken from one record per shape.  Profiles of parts add up, and their size follows
the number of different fields, not of records.  Kinds form a lattice:

    null < boolean < string, null < long < decimal < double < string,
    null < array, null < object

Two kinds join to the least one above both; where only ``string`` holds both, or
none does, the field is in conflict.  ``drift`` compares the joined kind of every
path with that of the run before and names what was added, dropped, widened,
narrowed or came into conflict, and how the share of missing values moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.lineage import cut_lineage
from strata.sinks.files import write_table
from strata.sinks.store import Store

PROFILE = "path string, kind string, rows long, records long"
#: Numbers widen along this chain (fixed order).
NUMBERS = ("long", "decimal", "double")
DEPTH = 8


def _kind(value: Column) -> Column:
    """Kind of a variant value."""
    name = F.schema_of_variant(value)
    return (F.when(name.isNull() | (name == "VOID"), "null").when(name.startswith("OBJECT"), "object")
            .when(name.startswith("ARRAY"), "array").when(name.startswith("DECIMAL"), "decimal")
            .when(name.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "long").when(name.isin("DOUBLE", "FLOAT"), "double")
            .when(name == "BOOLEAN", "boolean").otherwise("string"))


def profile(records: DataFrame, json_col: str = "record", depth: int = DEPTH) -> DataFrame:
    """``path``, ``kind``, ``rows`` (records with that kind at that path) and ``records`` (all records).

    ``json_col`` holds one JSON object per row; rows that are no object count as
    records without fields.  Objects are followed ``depth`` levels down, arrays
    are one value.  An explicit null has the kind ``null``; an absent field adds nothing.
    """
    value = F.try_parse_json(F.col(json_col))
    shape = F.regexp_replace(F.schema_of_variant(value), r"DECIMAL\(\d+, *\d+\)", "DECIMAL")
    # one pass over the records: those of one shape are alike in everything that is counted
    shapes = cut_lineage(records.groupBy(shape.alias("shape")).agg(
        F.count(F.lit(1)).alias("rows"), F.any_value(json_col).alias("record")), "record-shapes")
    level = shapes.select(F.lit("").alias("path"), F.try_parse_json("record").alias("value"), "rows")
    found = None
    for _ in range(depth):
        inner = F.variant_get(F.when(_kind(F.col("value")) == "object", F.col("value")), "$", "map<string, variant>")
        below = level.select("path", "rows", F.explode(inner).alias("key", "value")).select(
            F.when(F.col("path") == "", F.col("key")).otherwise(F.concat_ws(".", "path", "key")).alias("path"),
            _kind(F.col("value")).alias("kind"), "rows", F.to_json("value").alias("value"))
        below = cut_lineage(below, "record-fields")
        kinds = below.select("path", "kind", "rows")
        found = kinds if found is None else found.unionByName(kinds)
        objects = below.filter("kind = 'object'")
        if objects.isEmpty():
            break
        level = objects.select("path", F.parse_json("value").alias("value"), "rows")
    total = shapes.agg(F.sum("rows").alias("records"))
    counts = found.groupBy("path", "kind").agg(F.sum("rows").alias("rows"))
    return counts.join(F.broadcast(total))            # one row: the number of records


def merged(a: DataFrame, b: DataFrame) -> DataFrame:
    """Profile of the records of both profiles."""
    both = a.unionByName(b)
    sums = [p.agg(F.coalesce(F.max("records"), F.lit(0)).alias("n")) for p in (a, b)]
    total = sums[0].unionByName(sums[1]).agg(F.sum("n").alias("records"))
    return (both.groupBy("path", "kind").agg(F.sum("rows").alias("rows")).join(F.broadcast(total))
            .select("path", "kind", "rows", "records"))


def join_kinds(kinds: Column) -> Column:
    """Least kind above all of an array of kinds; ``conflict`` where they only meet as text."""
    some = F.array_distinct(F.filter(kinds, lambda k: k != "null"))
    numbers = F.array(*[F.lit(k) for k in NUMBERS])
    widest = F.coalesce(*[F.when(F.array_contains(some, k), F.lit(k)) for k in reversed(NUMBERS)])
    return (F.when(F.size(some) == 0, "null").when(F.size(some) == 1, F.element_at(some, 1))
            .when(F.size(F.array_except(some, numbers)) == 0, widest).otherwise("conflict"))


def fields(profile_: DataFrame) -> DataFrame:
    """One row per path: ``kind`` (joined), ``rows`` with a value and ``missing`` (share of records without one)."""
    value = F.sum(F.when(F.col("kind") != "null", F.col("rows")).otherwise(0))
    return profile_.groupBy("path").agg(
        join_kinds(F.collect_set("kind")).alias("kind"), value.alias("rows"),
        (1 - value / F.max("records")).alias("missing"))


def drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """``path``, ``change``, ``old_kind``, ``new_kind``, ``old_missing``, ``new_missing`` of every path whose
    kind or presence changed.  Changes: added, dropped, widened, narrowed, conflict."""
    o = fields(old).select("path", *[F.col(c).alias(f"old_{c}") for c in ("kind", "missing")])
    n = fields(new).select("path", *[F.col(c).alias(f"new_{c}") for c in ("kind", "missing")])
    both = o.join(n, "path", "full_outer")
    was, now = F.col("old_kind"), F.col("new_kind")
    joined = join_kinds(F.array(was, now))
    change = (F.when(was.isNull(), "added").when(now.isNull(), "dropped")
              .when((now == "conflict") | (was == "conflict") & (now != was), "conflict")
              .when(was == now, None).when(joined == "conflict", "conflict").when(joined == now, "widened")
              .otherwise("narrowed"))
    return (both.withColumn("change", change).filter("change is not null")
            .select("path", "change", "old_kind", "new_kind", "old_missing", "new_missing"))


class DriftError(RuntimeError):
    """The records' schema moved in a way that the run refuses."""


class SchemaHistory:
    """The profile of the last accepted run, stored below a lake root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.store = spark, f"{root.rstrip('/')}/schema_profiles", Store(spark)

    def last(self) -> DataFrame | None:
        run = self.store.read_text(f"{self.root}/CURRENT")
        return self.spark.read.schema(PROFILE).parquet(f"{self.root}/{run}") if run else None

    def check(self, new: DataFrame, refuse: tuple[str, ...] = ("dropped", "conflict")) -> list:
        """Rows of the drift since the last run; raises where a change is among ``refuse``.

        The rows are as many as fields changed."""
        old = self.last()
        rows = drift(old, new).orderBy("path").collect() if old is not None else []
        bad = [r for r in rows if r["change"] in refuse]
        if bad:
            raise DriftError("; ".join(f"{r['path']}: {r['change']} ({r['old_kind']} -> {r['new_kind']})" for r in bad))
        return rows

    def accept(self, new: DataFrame, run: str) -> None:
        """Store a profile as that of the last run."""
        write_table(new, f"{self.root}/{run}", mode="overwrite")
        self.store.replace(f"{self.root}/CURRENT", run)
