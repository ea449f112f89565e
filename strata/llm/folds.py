"""Fixed train and held-out folds by document id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def remainder(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3 (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(remainder(doc_id) == 1, F.lit(False))


def may_learn(doc_id: str = "doc_id") -> Column:
    """Rows with an id outside the held-out fold; a null id is never learned from."""
    return F.coalesce(remainder(doc_id) != 1, F.lit(False))
