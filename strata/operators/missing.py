"""P3 explained: which columns cost which rows.

Each row is reduced to a bit mask of its missing columns (null, or NaN in floating
columns: what ``drop_incomplete`` looks at), and masks are counted by one
aggregate with map-side combine.  The masks that occur are few however many rows
there are, so everything else is arithmetic on that small table: how many rows a
column is missing in, how many it alone costs, and how many all columns cost.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.names import quoted

WORD_BITS = 62                   # bits per mask word; tables of more columns use several words


def _missing(df: DataFrame, name: str) -> Column:
    col = F.col(quoted(name))
    if df.schema[name].dataType.typeName() in ("float", "double"):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def missing_masks(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """``mask`` (array of bit words, column i at bit i % 62 of word i // 62) and ``rows``."""
    names = df.columns if subset is None else subset
    words = [names[i:i + WORD_BITS] for i in range(0, len(names), WORD_BITS)] or [[]]

    def word(cols: list[str]) -> Column:
        bits = [F.when(_missing(df, c), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(cols)]
        return reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("long"))

    return (df.select(F.array(*[word(w) for w in words]).alias("mask"))
            .groupBy("mask").agg(F.count(F.lit(1)).alias("rows")))


def missing_costs(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """One row per column: ``column``, ``n_missing`` (rows that lack it), ``n_alone`` (rows that
    would stay if only this column were left out of the check), ``n_lost`` (rows that any
    column costs) and ``n_rows``.  A column with n_missing = n_rows empties the table."""
    names = df.columns if subset is None else subset
    masks, n_words = missing_masks(df, names), max(1, -(-len(names) // WORD_BITS))

    def at(i: int) -> Column:
        return F.element_at("mask", i // WORD_BITS + 1)

    def bit(i: int) -> Column:
        return F.lit(1 << (i % WORD_BITS)).cast("long")

    zero = F.lit(0).cast("long")
    n = F.coalesce(F.sum("rows"), zero)
    clean = F.forall("mask", lambda w: w == 0)
    sums = [n.alias("n_rows"), F.coalesce(F.sum(F.when(~clean, F.col("rows"))), zero).alias("n_lost")]
    for i in range(len(names)):
        set_ = at(i).bitwiseAND(bit(i)) != 0
        only = [F.lit(1 << (i % WORD_BITS) if k == i // WORD_BITS else 0).cast("long") for k in range(n_words)]
        alone = F.col("mask") == F.array(*only)
        sums += [F.coalesce(F.sum(F.when(set_, F.col("rows"))), zero).alias(f"missing_{i}"),
                 F.coalesce(F.sum(F.when(alone, F.col("rows"))), zero).alias(f"alone_{i}")]
    one = masks.agg(*sums)
    per = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"missing_{i}").alias("n_missing"),
                             F.col(f"alone_{i}").alias("n_alone")) for i, c in enumerate(names)])
    return (one.select(F.explode(per).alias("c"), "n_lost", "n_rows")
            .select("c.column", "c.n_missing", "c.n_alone", "n_lost", "n_rows"))


def emptying_columns(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """The columns that cost the most rows on their own, worst first: candidates for stray columns."""
    costs = missing_costs(df, subset)
    return costs.filter("n_alone > 0").orderBy(F.desc("n_alone"), "column")
