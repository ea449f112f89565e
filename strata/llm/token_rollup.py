"""Token counts as delta-maintained rollups.

Additive totals by source, language and tokenizer version.  Every change batch
(inserts, deletes, revised counts) is reduced to signed sums per key and written
as one delta; the totals are the sums of the committed deltas.  A batch is
written to its own folder and then entered in the commit list: writing it again
replaces the same folder, and a batch that is already in the list is ignored,
so repeated and interrupted commits count once.

Changes have the columns doc_id, source, lang, version, op, n_tokens, n_chars,
old_tokens, old_chars; op is ``insert``, ``delete`` (takes n_* off) or
``revise`` (adds n_* less old_*).  Defined cases: null keys form groups of their
own, null counts are zero, unknown ops raise, empty batches commit nothing but
their name, keys whose documents are all gone leave the totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "version"]
DELTA = "source string, lang string, version string, n_docs long, n_tokens long, n_chars long, batch string"
#: Token patterns by tokenizer version.
TOKENIZERS = {"words-1": r"[^\x20\x09-\x0D]+", "alnum-1": "[0-9A-Za-z]+"}


def count_tokens(version: str, text: str = "text") -> Column:
    """Tokens of a text under a tokenizer version; null counts as empty."""
    return F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(TOKENIZERS[version])).cast("long")


def signed(changes: DataFrame) -> DataFrame:
    """Sums of the changes per key."""
    sign = (F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).when(F.col("op") == "revise", 0)
            .otherwise(F.raise_error(F.concat(F.lit("unknown op: "), F.coalesce("op", F.lit("null"))))))
    zero = F.lit(0).cast("long")

    def amount(new: str, old: str) -> Column:
        n, o = F.coalesce(F.col(new), zero), F.coalesce(F.col(old), zero)
        return F.sum(F.when(F.col("op") == "revise", n - o).otherwise(sign * n))

    return changes.groupBy(*KEYS).agg(F.sum(sign).cast("long").alias("n_docs"),
                                      amount("n_tokens", "old_tokens").alias("n_tokens"),
                                      amount("n_chars", "old_chars").alias("n_chars"))


class TokenRollup:
    """Rollup tables under ``path`` (a shared folder)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.deltas, self.commits = spark, f"{path}/deltas", f"{path}/commits"
        spark.createDataFrame([], "batch string").write.mode("append").parquet(self.commits)

    def committed(self) -> DataFrame:
        return self.spark.read.schema("batch string").parquet(self.commits).distinct()

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch; False if it was applied before."""
        if not batch.replace("-", "").isalnum():
            raise ValueError("a batch name has letters, digits and hyphens only")
        if not self.committed().filter(F.col("batch") == batch).isEmpty():
            return False
        signed(changes).write.mode("overwrite").parquet(f"{self.deltas}/batch={batch}")
        self.spark.createDataFrame([(batch,)], "batch string").write.mode("append").parquet(self.commits)
        return True

    def totals(self) -> DataFrame:
        """n_docs, n_tokens and n_chars per key over the committed batches."""
        if self.committed().isEmpty():
            return self.spark.createDataFrame([], DELTA).drop("batch")
        rows = self.spark.read.schema(DELTA).parquet(self.deltas).join(self.committed(), "batch")
        return (rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in ("n_docs", "n_tokens", "n_chars")])
                .filter("n_docs <> 0 or n_tokens <> 0 or n_chars <> 0"))


def changes(docs: DataFrame, version: str, op: str, **columns: Column) -> DataFrame:
    """Change rows of ``docs``; ``columns`` gives n_tokens, n_chars, old_tokens, old_chars."""
    none = F.lit(None).cast("long")
    cells = {c: columns.get(c, none).cast("long").alias(c) for c in ("n_tokens", "n_chars", "old_tokens", "old_chars")}
    return docs.select("doc_id", "source", "lang", F.lit(version).alias("version"), F.lit(op).alias("op"),
                       *cells.values())
