"""Page arithmetic: how records map to crawl pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def page_of(key: str, per_page: int = 200) -> Column:
    """1-based page number of a 0-based integer record key (``key div per_page + 1``).

    Integral division keeps the arithmetic exact for any bigint key.
    """
    return F.expr(f"CAST(`{key}` AS BIGINT) div {int(per_page)} + 1")


def on_page(key: str, page: int, per_page: int = 200) -> Column:
    """``page_of(key) == page`` written as a key range, so Parquet can push it
    into the scan and skip row groups by their min/max statistics."""
    lo = (int(page) - 1) * int(per_page)
    return (F.col(key) >= F.lit(lo)) & (F.col(key) < F.lit(lo + int(per_page)))
