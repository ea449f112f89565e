"""Classify fetched pages and route failures to sentinel rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.flatten import explode_records, flat_schema

OK, HTTP_ERROR, UNPARSABLE, EMPTY = "ok", "http_error", "unparsable", "empty"


def outcome_column(body: str = "body", status: str = "status") -> Column:
    """Classify a page: status first, then unparsable text, then an empty array.

    The elements are counted by ``json_array_length``, which walks the text once
    without building records, so a page whose records are parsed elsewhere is not
    parsed into records a second time.  A lone object is one record.
    """
    text = F.trim(F.col(body), F.lit(" \t\r\n"))
    n = F.coalesce(F.json_array_length(body),
                   F.when(text.startswith("{") & F.try_parse_json(body).isNotNull(), 1), F.lit(-1))
    by_size = F.element_at(F.array(F.lit(UNPARSABLE), F.lit(EMPTY), F.lit(OK)),
                           (F.signum(n) + 2).cast("int"))
    return (F.when(F.col(status).isNull() | (F.col(status) != 200), F.lit(HTTP_ERROR))
             .when(F.col(body).isNull(), F.lit(UNPARSABLE))
             .otherwise(by_size))


def sentinel_rows(failed: DataFrame, record_schema: T.StructType,
                  id_field: str = "id", url_col: str = "url",
                  sep: str = ".", keep_url: str | None = None) -> DataFrame:
    """One row per failed page: ``id_field`` = the request URL, every other field null.
    The columns are those of flattened records.  An id that is no text cannot hold the
    URL and is null; ``keep_url`` adds the URL in a column of that name."""
    cols = []
    for f in flat_schema(record_schema, sep).fields:
        if f.name == id_field:
            cols.append(F.col(url_col).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    if keep_url:
        cols.append(F.col(url_col).alias(keep_url))
    return failed.select(*cols)


def route_pages(envelopes: DataFrame, record_schema: T.StructType,
                id_field: str = "id", keep: list[str] | None = None,
                position: str | None = "position", sep: str = ".",
                rescue_col: str | None = None,
                keep_url: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Split page envelopes into (records, sentinels).

    Records are the flattened elements of good pages, with ``keep`` columns of
    the envelope (default: ``page``) and the element ``position`` carried so
    crawl order stays explicit; ``rescue_col`` keeps unknown keys (see
    ``explode_records``).  Both outputs derive from ``envelopes``; pass a
    materialised envelope frame so remote pages are fetched only once.
    """
    keep = keep if keep is not None else ["page"]
    # Good pages: explode the parsed array of 200-status pages; a null (failed
    # or unparsable) or empty array yields no rows, so no separate filter or
    # second parse is needed.
    good_body = F.when(F.col("status") == 200, F.col("body"))
    records = explode_records(envelopes.withColumn("body", good_body), "body", record_schema,
                              keep=keep, position=position, sep=sep, rescue_col=rescue_col)
    failed = envelopes.filter(outcome_column() != OK)
    return records, sentinel_rows(failed, record_schema, id_field, sep=sep, keep_url=keep_url)
