"""S1 on a file store: page bodies read by Spark's own file systems.

The session's Hadoop settings (endpoint, keys, path style: S5) apply, as for any
other read.  A page is a file or a folder with one data file; with ``{chunk}`` in
the template a file holds several pages, one JSON line each.
"""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks.store import Store, is_io_error

#: Numbers put into one glob.
GLOB_NUMBERS = 500


def _escaped(text: str) -> str:
    """``text`` as a glob that matches itself."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", text)


def _globs(template: str, slot: str, numbers: list[int], per_page: int) -> list[str]:
    before, after = (_escaped(x.replace("{per_page}", str(per_page))) for x in template.split(slot, 1))
    parts = [numbers[i:i + GLOB_NUMBERS] for i in range(0, len(numbers), GLOB_NUMBERS)]
    return [f"{before}{{{','.join(map(str, p))}}}{after}" for p in parts]


def _number_in(path: Column, template: str, slot: str, per_page: int) -> Column:
    before, after = (x.replace("{per_page}", str(per_page)) for x in template.split(slot, 1))
    tail = before.rsplit("/", 1)[-1]
    pattern = re.escape("/" + tail) + r"(-?\d+)" + re.escape(after.rstrip("/")) + r"(/|$)"
    return F.regexp_extract(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), pattern, 1).cast("int")


def read_page_files(spark: SparkSession, url: str, first: int, last: int, per_page: int = 200,
                    pages_per_file: int = 1) -> DataFrame:
    """Envelopes (page, url, status, body) of the pages ``first..last``: status 404 where there is no
    file, 500 where a page's folder holds several, null where the store does not answer; a body that
    is not UTF-8 is null."""
    slot = "{chunk}" if "{chunk}" in url else "{page}"
    if slot not in url:
        raise ValueError("the template needs {page} or {chunk}")
    lo, hi = min(first, last), max(first, last)
    per = pages_per_file if slot == "{chunk}" else 1
    numbers = list(range(lo // per, hi // per + 1))
    store = Store(spark)
    try:
        globs, silent = [g for g in _globs(url, slot, numbers, per_page) if store.matches(g)], False
    except Py4JJavaError as e:
        if not is_io_error(e):
            raise
        globs, silent = [], True
    number = F.floor(F.col("page") / per).cast("int")
    asked = spark.range(lo, hi + 1).select(F.col("id").cast("int").alias("page")).select(
        "page", number.alias("number"),
        F.replace(F.lit(url.replace("{per_page}", str(per_page))), F.lit(slot), number.cast("string")).alias("url"))
    if not globs:
        return asked.select("page", "url", F.lit(None if silent else 404).cast("int").alias("status"), F.lit(None).cast("string").alias("body"))
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(globs)
             .select(_number_in(F.col("path"), url, slot, per_page).alias("number"),
                     F.rtrim(F.try_validate_utf8(F.col("content").cast("string")), F.lit("\n")).alias("text")))
    found = files.groupBy("number").agg(F.count(F.lit(1)).alias("files"), F.any_value("text").alias("text"))
    out = asked.join(found, "number", "left")
    status = F.when(F.col("files").isNull(), 404).when(F.col("files") > 1, 500).otherwise(200)
    if slot == "{page}":
        return out.select("page", "url", status.alias("status"), F.when(status == 200, F.col("text")).alias("body"))
    lines = (files.groupBy("number").agg(F.count(F.lit(1)).alias("files"), F.any_value("text").alias("text"))
             .filter("files = 1").select(F.explode(F.split("text", "\n")).alias("line"))
             .select(F.from_json("line", "page int, status int, body string").alias("r"))
             .filter("r.page is not null").select("r.page", F.coalesce("r.status", F.lit(200)).alias("own"), "r.body"))
    return (out.drop("text").join(lines, "page", "left")
            .select("page", "url", F.when(status != 200, status).otherwise(F.coalesce("own", F.lit(404))).alias("status"),
                    F.when(status == 200, F.col("body")).alias("body")))
