"""Exact dedup with DataFrame functions only: 128-bit content hash groups, byte
comparison inside the groups, one survivor per group.

A text's content is the text without ``[ \\t\\n\\x0b\\f\\r]``; null counts as
empty.  Groups share the MD5 of the content.  A group whose smallest and
largest content differ holds a collision; the hashes of such groups (none, as
a rule) are extended by the content itself, so that only equal bytes stay
together.  No step gathers a group: sizes and survivors are partial aggregates,
and the way back to the rows joins on (hash, salt), which deals a hot group out.

Defined cases: a null doc_id sorts before all others and is a document of its
own; of rows that are alike in length and doc_id one stays, the first by its row
number (``rows``), so that every group keeps exactly one row; an empty table gives
no rows; texts are compared whole, whatever their length; extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.blocks import stored
from strata.llm.rows import with_row_number

#: Characters that do not count (fixed by the contract).
IGNORED = " \t\n\x0b\f\r"
SALTS = 32


def content(text: Column) -> Column:
    """The text without the ignored characters; plain byte search, no regular expression."""
    out = F.coalesce(text, F.lit(""))
    for c in IGNORED:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def exact_groups(docs: DataFrame, fingerprint: Callable[[Column], Column] = F.md5,
                 unique_ids: bool = False) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row.

    The row with the most code points in its text stays; ties go to the
    smallest doc_id, then to the smallest row number.  ``fingerprint`` is the group
    hash (a weak one is for tests); ``unique_ids`` says that no doc_id is null or
    repeated, which makes row numbers needless.
    """
    rows, row = (docs, "doc_id") if unique_ids else with_row_number(docs, "exact-numbers")
    raw = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                      F.col(row).cast("long").alias("row")).withColumn("body", content(F.col("text")))
    keyed = raw.select("doc_id", "row", F.coalesce(F.char_length("text"), F.lit(0)).alias("size"),
                       "body", fingerprint(F.col("body")).alias("hash"))
    mixed = stored(keyed.groupBy("hash").agg(F.min("body").alias("low"), F.max("body").alias("high"))
                   .filter(F.col("low") != F.col("high")).select("hash"), "exact-collisions")
    if mixed.isEmpty():
        key = F.col("hash")
    else:
        keyed = keyed.join(mixed.withColumn("mixed", F.lit(True)), "hash", "left")
        key = F.when(F.col("mixed"), F.concat_ws(":", "hash", "body")).otherwise(F.col("hash"))
    rows = stored(keyed.select("doc_id", "row", "size", key.alias("key"), F.sha2("body", 256).alias("text_sha256"),
                               F.pmod(F.xxhash64("row"), F.lit(SALTS)).alias("salt")), "exact-keys")
    best = F.min(F.struct((-F.col("size")).alias("size"), "doc_id", "row"))
    part = rows.groupBy("key", "salt").agg(F.count(F.lit(1)).alias("n"), best.alias("best"))
    group = part.groupBy("key").agg(F.sum("n").alias("group_size"), F.min("best").alias("best"))
    back = part.select("key", "salt").join(group, "key")
    return (rows.join(back, ["key", "salt"])
            .select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
                    (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256"))
