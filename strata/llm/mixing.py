"""Mixing sources to target weights by entropy balancing, with DataFrame functions only.

Each source gets a word target; a document's rate ``w`` (how often the mix
repeats it, 0 to 2) stays as near to 1 in relative entropy as the target of its
source allows.  The solution of that convex problem is an exponentially tilted
rate, ``w = 2 / (1 + exp(-t * size / scale))``, with one dual value ``t`` per
source.  ``t`` is found by Newton steps on the dual, kept inside a bracket; every
step is one join and one aggregate over the size histogram of the sources, for
all sources at once.  Rates depend on source and size alone, so the histogram
(source, size, documents) carries the whole problem: a source of W words has at
most sqrt(2 W) distinct sizes.

Rates become whole copies by cumulative rounding over a source's sizes, which
leaves at most half of its longest document; repair passes then add or take
copies of the largest size that still fits.  In a cell (source, size) the
documents with the smallest hashes get the odd copies; the hash rank comes from a
range partitioning, so a hot cell spreads over tasks.  Sums that decide anything
are decimals or integers, which makes reruns equal whatever the task order.

Defined cases: a null text has size 0; a null source is a source of its own,
ordered last; null and repeated ids are documents of their own; size 0 is taken
0 times; an empty table gives no rows; long texts are counted whole; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.blocks import stored
from strata.llm.positions import numbered, positions, spans, task

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
MOST = 2.0                       # no document is taken more often
EXACT = "decimal(32,6)"
NEWTON_STEPS = 60
REPAIRS = 40
TOLERANCE = 1e-5                 # of a target: repair passes end below it


def source_key(source: Column) -> Column:
    """Text without nulls that sorts by UTF-8 bytes, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, src and size (words of the whole text)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), source_key(F.col("source")).alias("src"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))


def source_targets(cells: DataFrame, weights: tuple[int, ...], share: float) -> DataFrame:
    """src, source_size, target and scale of every source.

    A target is the source's weight times a common level, at most MOST times its
    size.  The level rises while capped sources leave an excess; each round is
    one aggregate whose row is all that reaches the driver.
    """
    size = F.col("size").cast("decimal(20,0)") * F.col("docs")
    totals = cells.groupBy("src").agg(F.sum(size).cast("long").alias("source_size"),
                                      F.sum(size * F.col("size")).cast("double").alias("squares"))
    ranked = positions(totals.withColumn("all", F.lit(0)), ["all"], [F.col("src")], "mix-sources")
    cycle = F.array(*[F.lit(w) for w in weights])
    rows = stored(ranked.select("src", "source_size", (F.col("source_size") * MOST).alias("cap"),
                                F.element_at(cycle, (F.pmod("pos", F.lit(len(weights))) + 1).cast("int")).alias("weight"),
                                (F.col("squares") / F.greatest("source_size", F.lit(1))).alias("scale")), "mix-sources")
    level, capped = 0.0, -1
    while True:
        over = F.col("cap") < level * F.col("weight") if capped >= 0 else F.lit(False)
        row = rows.agg(F.sum("source_size").alias("total"), F.sum(F.when(over, F.col("cap"))).alias("fixed"),
                       F.sum(F.when(~over, F.col("weight"))).alias("open"),
                       F.count(F.when(over, 1)).alias("capped")).head()
        if row["capped"] == capped or not row["open"] or not row["total"]:
            break
        capped, level = row["capped"], (share * row["total"] - (row["fixed"] or 0.0)) / row["open"]
    return rows.select("src", "source_size", F.least("cap", level * F.col("weight")).alias("target"),
                       F.greatest("scale", F.lit(1.0)).alias("scale"))


def rate(tilt: Column, size: Column, scale: Column) -> Column:
    """Tilted rate of a document; a null tilt stands for a source that gives all it may."""
    return F.coalesce(F.lit(MOST) / (1 + F.exp(-tilt * size / scale)), F.lit(MOST))


def tilts(cells: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` with tilt: the dual value at which a source's rates meet its target."""
    full = F.col("target") >= MOST * F.col("source_size")
    state = stored(sources.select("*", F.when(~full, F.lit(0.0)).alias("tilt"), F.lit(None).cast("double").alias("low"),
                                  F.lit(None).cast("double").alias("high")), "mix-dual")
    for _ in range(NEWTON_STEPS):
        w = rate(F.col("tilt"), F.col("size"), F.col("scale"))
        words = F.col("docs") * F.col("size")
        sums = (cells.join(state.filter("tilt is not null"), "src").groupBy("src")
                .agg(F.sum((words * w).cast(EXACT)).cast("double").alias("value"),
                     F.sum((words * F.col("size") / F.col("scale") * w * (1 - w / MOST)).cast(EXACT))
                     .cast("double").alias("slope")))
        gap = F.col("value") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap < 0, F.col("high")).otherwise(F.col("tilt"))
        moved = (state.join(sums, "src", "left").withColumn("gap", F.coalesce(F.abs(gap), F.lit(0.0)))
                 .withColumn("low", F.when(F.col("value").isNull(), F.col("low")).otherwise(low))
                 .withColumn("high", F.when(F.col("value").isNull(), F.col("high")).otherwise(high))
                 .withColumn("open", F.col("gap") > F.greatest(F.lit(0.25), F.col("target") * 1e-9)))
        reach = 2 * F.abs("tilt") + 4
        step = F.col("tilt") - gap / F.greatest("slope", F.lit(1e-6))
        near = F.greatest(F.least(step, F.col("tilt") + reach), F.col("tilt") - reach)
        inside = F.when(near <= F.col("low"), False).when(near >= F.col("high"), False).otherwise(True)
        new = F.when(inside, near).otherwise((F.coalesce("low", F.col("tilt") - reach)
                                              + F.coalesce("high", F.col("tilt") + reach)) / 2)
        state = stored(moved.select("src", "source_size", "target", "scale",
                                    F.when(F.col("open"), new).otherwise(F.col("tilt")).alias("tilt"),
                                    "low", "high", "open"), "mix-dual")
        if state.filter("open").isEmpty():
            break
        state = state.drop("open")
    return state.select("src", "source_size", "target", "scale", "tilt")


def rounded(cells: DataFrame, dual: DataFrame) -> DataFrame:
    """src, size, docs, target, source_size and copies of every cell: rates in whole copies."""
    by_size = Window.partitionBy("src").orderBy("size")
    most = F.col("docs") * int(MOST)
    out = cells.join(dual, "src").select(
        "src", "size", "docs", "target", "source_size",
        (F.col("docs") * rate(F.col("tilt"), F.col("size"), F.col("scale"))).alias("wanted"))
    out = out.withColumn("upto", F.sum("wanted").over(by_size)).withColumn(
        "before", F.coalesce(F.lag("upto").over(by_size), F.lit(0.0)))
    copies = F.round("upto").cast("long") - F.round("before").cast("long")
    out = stored(out.select("src", "size", "docs", "target", "source_size",
                            F.greatest(F.lit(0), F.least(most, copies)).alias("copies")), "mix-copies")
    for _ in range(REPAIRS):
        taken = F.sum(F.col("copies").cast("decimal(20,0)") * F.col("size"))
        gaps = out.groupBy("src").agg((F.max("target") - taken.cast("double")).alias("gap"))
        gaps = gaps.join(dual.select("src", "target"), "src").filter(
            F.abs("gap") >= F.greatest(F.lit(1.0), F.col("target") * TOLERANCE)).select("src", "gap")
        room = F.when(F.col("gap") > 0, most - F.col("copies")).otherwise(F.col("copies"))
        fit = out.join(gaps, "src").filter((F.col("size") > 0) & (F.col("size") <= F.abs("gap")) & (room > 0))
        best = stored(fit.groupBy("src").agg(F.max("size").alias("size"), F.max("gap").alias("gap")), "mix-repair")
        if best.isEmpty():
            break
        room = F.when(F.col("gap") > 0, most - F.col("copies")).otherwise(F.col("copies"))
        move = F.least(room, F.floor(F.abs("gap") / F.col("size")).cast("long"))
        out = stored(out.join(best, ["src", "size"], "left")
                     .withColumn("copies", F.col("copies") + F.coalesce(F.signum("gap").cast("long") * move, F.lit(0)))
                     .drop("gap"), "mix-copies")
    return out


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken of every document.

    Sources in code point order take the weights in turn and share ``share``
    times all words.
    """
    cell = ["src", "size"]
    rows = numbered(sizes(docs), cell, [F.xxhash64("doc_id"), F.col("doc_id")], "mix-rows")
    parts = stored(spans(rows, cell), "mix-spans")
    cells = stored(parts.filter("_off = 0").select(*cell, F.col("_size").alias("docs")), "mix-cells")
    plan = rounded(cells, tilts(cells, source_targets(cells, weights, share)))
    base = F.floor(F.col("copies") / F.col("docs")).cast("long")
    parts = parts.join(plan, cell).select(
        "_task", *cell, "_first", "_off", "source_size", "target", base.alias("base"),
        (F.col("copies") - base * F.col("docs")).alias("odd"))
    rank = F.col("_mid") - F.col("_first") + F.col("_off")
    copies = F.col("base") + F.when(rank < F.col("odd"), 1).otherwise(0)
    return (rows.withColumn("_task", task()).join(parts, ["_task", *cell])
            .select("doc_id", "size", "source_size", "target", copies.cast("long").alias("copies"),
                    (copies * F.col("size")).cast("long").alias("taken")))
