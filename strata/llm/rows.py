"""A number for every row of a table, the same at each read.

A table that comes straight from files has one already: the file and the row's
index in it, which Spark's hidden file columns give with any scan.  Files are
numbered once (a small stored table, broadcast up to ``MOST_FILES`` entries), so
neither the rows nor their texts are copied.  Any other frame, or a table of more
files, is stored once together with its numbers.

Added columns get names that the frame does not have.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.blocks import stored

MOST_FILES = 100_000             # entries of the broadcast table, some 200 bytes each
ROW_BITS = 36                    # rows of one file
PLAIN = {"LogicalRelation", "Project", "Filter", "SubqueryAlias"}


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores added until ``df`` has no such column in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def _plain_scan(df: DataFrame) -> bool:
    """Whether every row of ``df`` is one row of a file."""
    todo = [df._jdf.queryExecution().analyzed()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() not in PLAIN:
            return False
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return True


def with_row_number(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """(``docs`` with a long row number, its column): distinct and not negative."""
    row = free_name(docs, "row_number")
    if _plain_scan(docs):
        try:
            meta = docs.metadataColumn("_metadata")
            paths = docs.select(meta.getField("file_path").alias("path")).distinct()
            index = meta.getField("row_index")
            docs.select(index)
        except AnalysisException:              # a source without hidden file columns
            paths = None
        if paths is not None:
            numbers = stored(paths.withColumn("file", F.row_number().over(Window.orderBy("path")).cast("long")), name)
            if numbers.count() <= MOST_FILES:
                at, file = free_name(docs, "file_path"), free_name(docs, "file_number")
                tagged = docs.select("*", meta.getField("file_path").alias(at), index.alias(row))
                named = numbers.select(F.col("path").alias(at), F.col("file").alias(file))
                number = F.shiftleft(F.col(file), ROW_BITS) + F.col(row)
                return (tagged.join(F.broadcast(named), at)
                        .select(*[F.col(_quoted(c)) for c in docs.columns], number.alias(row))), row
    return stored(docs.withColumn(row, F.monotonically_increasing_id()), name), row


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
