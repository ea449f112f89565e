"""S1 as a checkpointed stream: a crawl that can be stopped and taken up again.

Every batch of the stream is a bounded list of pages; its rows (one per requested
page, with the request's number ``at``) go to an exactly-once file sink, and the
checkpoint holds the last request number.  A crawl that was stopped goes on after
the last finished batch: pages that are stored and good are not fetched again,
failed ones are asked for once more in every call.  Stores are keyed by URL
template and page size, so one folder serves several crawls.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.sequence import with_sequence
from strata.sinks.store import Store
from strata.sources.paged_json import STREAM_SCHEMA, format_ranges, register

#: Pages of one batch: what a stop in the middle of it costs at most.
PAGES_PER_BATCH = 500


def crawl_key(url: str, per_page: int, pages_per_file: int = 1) -> str:
    """Folder name of a crawl: its URL template and page size."""
    return hashlib.sha256(f"{per_page} {pages_per_file} {url}".encode()).hexdigest()[:24]


def good_page() -> Column:
    """A page that need not be fetched again: status 200 and a body that is JSON."""
    return (F.col("status").eqNullSafe(200)) & F.try_parse_json("body").isNotNull()


class CrawlStore:
    """Stored pages of one crawl below ``root``."""

    def __init__(self, spark: SparkSession, root: str, url: str, per_page: int = 200, pages_per_file: int = 1):
        self.spark, self.url, self.per_page, self.per_file = spark, url, per_page, pages_per_file
        self.root = f"{root.rstrip('/')}/{crawl_key(url, per_page, pages_per_file)}"
        self.store = Store(spark)

    def requests(self) -> DataFrame:
        """All finished requests: ``at``, page, url, status, body."""
        path = f"{self.root}/pages"
        if not self.store.exists(f"{path}/_spark_metadata"):
            return self.spark.createDataFrame([], STREAM_SCHEMA)
        return self.spark.read.schema(STREAM_SCHEMA).parquet(path)

    def best(self) -> DataFrame:
        """``page``, ``good`` and ``at`` of the request that stands for each page: the latest good one, else the latest."""
        rank = F.struct(good_page().alias("good"), "at")
        return (self.requests().groupBy("page").agg(F.max(rank).alias("best"))
                .select("page", "best.good", "best.at"))

    def pages(self, first: int, last: int) -> DataFrame:
        """One envelope per requested page of the range."""
        chosen = self.best().filter(F.col("page").between(min(first, last), max(first, last))).select("at")
        return self.requests().join(chosen, "at", "left_semi").select("page", "url", "status", "body")

    def open_pages(self, first: int, last: int) -> DataFrame:
        """``page`` of the range without a good stored page."""
        lo, hi = min(first, last), max(first, last)
        wanted = self.spark.range(lo, hi + 1).select(F.col("id").cast("int").alias("page"))
        return wanted.join(self.best().filter("good"), "page", "left_anti")

    def run(self, first: int, last: int, pages_per_batch: int = PAGES_PER_BATCH, **options) -> int:
        """Fetch the open pages of the range batch by batch; returns how many were asked for."""
        plan = self.store.read_text(f"{self.root}/PLAN")
        if plan:                                         # a batch that was cut short is finished as it was planned
            plan = json.loads(plan)
            if self._next() < plan["base"] + plan["count"]:
                self._batch(plan, options)
        order = F.col("page").desc() if first > last else F.col("page").asc()
        todo = with_sequence(self.open_pages(first, last), [order], "seq")
        n = todo.count()
        for lo in range(0, n, pages_per_batch):
            rows = todo.filter(F.col("seq").between(lo, lo + pages_per_batch - 1)).orderBy("seq").collect()
            plan = {"base": self._next(), "count": len(rows), "pages": format_ranges([r["page"] for r in rows])}
            self.store.replace(f"{self.root}/PLAN", json.dumps(plan))
            self._batch(plan, options)
        return n

    def _next(self) -> int:
        """Number of the next request."""
        done = self.requests().agg(F.max("at")).head()[0]
        return 0 if done is None else done + 1

    def _batch(self, plan: dict, options: dict) -> None:
        """One batch of the stream: the planned pages take the request numbers from ``base`` on."""
        register(self.spark)
        src = (self.spark.readStream.format("paged_json").option("url", self.url).option("per_page", self.per_page)
               .option("pages_per_file", self.per_file).option("pages", plan["pages"]).option("base", plan["base"]))
        for k, v in options.items():
            src = src.option(k, v)
        query = (src.load().writeStream.format("parquet").option("checkpointLocation", f"{self.root}/checkpoint")
                 .trigger(availableNow=True).start(f"{self.root}/pages"))
        query.awaitTermination()


def crawl_stream(spark: SparkSession, url: str, first: int, last: int, store: str, per_page: int = 200,
                 pages_per_batch: int = PAGES_PER_BATCH, pages_per_file: int = 1, **options) -> DataFrame:
    """Crawl ``first..last`` into ``store``, taking up what is there; returns the envelopes."""
    crawl = CrawlStore(spark, store, url, per_page, pages_per_file)
    crawl.run(first, last, pages_per_batch, **options)
    return crawl.pages(first, last)

