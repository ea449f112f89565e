"""Paged JSON source as a Python Data Source (``format("paged_json")``).

One row per page: ``page INT, url STRING, status INT, body STRING``.  Pages are
fetched inside Python workers, one input partition per group of consecutive
pages, so a crawl is parallel across tasks instead of a driver loop.  Fetching
has no side effects: a retried task fetches again and emits each page once.

Options
  url           template with ``{page}`` and ``{per_page}``; ``http(s)://`` is
                fetched over the network; ``file:``, a plain path or another
                file-system scheme (``s3a://``, ``hdfs://`` ... through
                ``pyarrow.fs``) is read from shared storage -- a folder holding
                one data file, as written by ``df.write.text``, or a file.
                With ``{chunk}`` in place of ``{page}`` an object holds
                ``pages_per_file`` pages, one JSON line per page
                (``{"page": 3, "status": 200, "body": "..."}``, status optional),
                page ``p`` in chunk ``p // pages_per_file``; a task reads each
                object once.
  first, last   page range in crawl order (``first=40, last=1`` walks down)
  per_page      records per page (default 200)
  pages_per_file  pages of one object, for ``{chunk}`` templates
  pause_seconds pause after each page, per task (default 0)
  concurrency   number of input partitions (default 1: one sequential crawl,
                the reference's request rate)
  requests_per_second  one schedule for all tasks (see ``Slots``): the rate of
                the whole crawl, whatever the number of tasks; replaces the pause
  timeout_seconds  per-request timeout (default 30)
  retries       extra attempts for transient failures -- no response, 429 or
                5xx -- with exponential backoff from ``backoff_seconds``
                (defaults 2 and 1.0); what still fails is emitted with its
                status and routed aside downstream (P4)

As a stream (``spark.readStream``) the source fetches named pages: ``pages``
(ranges in crawl order, ``40-21,19``), which take the offsets from ``base`` on.  Rows
then also carry their offset ``at``; the checkpoint holds how far the crawl came.

This module imports only the standard library, PySpark and (lazily) pyarrow,
so it can be pickled by value into workers that do not have the package
installed.
"""

from __future__ import annotations

import http.client
import json
import math
import os
import time
import urllib.error
import urllib.request
from urllib.parse import urlparse

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "page INT, url STRING, status INT, body STRING"
STREAM_SCHEMA = "at LONG, " + SCHEMA


def _is_data_file(name: str) -> bool:
    base = name.rsplit("/", 1)[-1]
    return not base.startswith((".", "_")) and not base.endswith(".crc")


def _text(raw: bytes, strip: bool = False) -> str | None:
    """The body as text, or None (an unparsable page) when it is not UTF-8."""
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text.rstrip("\n") if strip else text


def _read_local(path: str) -> tuple[int | None, str | None]:
    if os.path.isdir(path):
        files = sorted(os.path.join(path, n) for n in os.listdir(path) if _is_data_file(n))
        if len(files) != 1:
            return (404, None) if not files else (500, None)
        path = files[0]
    if not os.path.isfile(path):
        return 404, None
    with open(path, "rb") as fh:
        return 200, _text(fh.read(), strip=True)


def _read_fs(url: str) -> tuple[int | None, str | None]:
    """Any other file-system URI through pyarrow (s3/s3a, hdfs, gs ...)."""
    try:
        from pyarrow import fs as pafs

        uri = "s3://" + url[len("s3a://"):] if url.startswith("s3a://") else url
        filesystem, path = pafs.FileSystem.from_uri(uri)
        info = filesystem.get_file_info(path)
        if info.type == pafs.FileType.Directory:
            sel = pafs.FileSelector(path, recursive=False)
            files = sorted(i.path for i in filesystem.get_file_info(sel)
                           if i.type == pafs.FileType.File and _is_data_file(i.path))
            if len(files) != 1:
                return (404, None) if not files else (500, None)
            path = files[0]
        elif info.type != pafs.FileType.File:
            return 404, None
        with filesystem.open_input_stream(path) as fh:
            return 200, _text(fh.read(), strip=True)
    except (OSError, ValueError, NotImplementedError):      # pyarrow's errors are among these
        return None, None


def fetch(url: str, timeout: float = 30.0) -> tuple[int | None, str | None]:
    """Return (status, body text).  Network errors give (None, None)."""
    u = urlparse(url)
    if u.scheme in ("http", "https"):
        req = urllib.request.Request(url, headers={"Accept": "application/json"})
        try:
            with urllib.request.urlopen(req, timeout=timeout) as resp:
                return resp.status, _text(resp.read())
        except urllib.error.HTTPError as e:
            return e.code, None
        except (urllib.error.URLError, http.client.HTTPException, TimeoutError, OSError):
            return None, None
    if u.scheme in ("", "file"):
        return _read_local(u.path if u.scheme == "file" else url)
    return _read_fs(url)


def page_url(root: str, name: str = "page") -> str:
    """URL template for page folders ``<root>/<name>=<n>`` as written by
    ``df.write.partitionBy(name).text(root)``; ``root`` may be a plain path,
    a ``file:`` URI or another file-system URI.  ``name="chunk"``: folders of several pages."""
    u = urlparse(root)
    if u.scheme in ("", "file"):
        root = "file://" + os.path.abspath(u.path if u.scheme == "file" else root)
    return root.rstrip("/") + "/" + name + "={" + name + "}"


def page_request_url(template: str, page: int, per_page: int) -> str:
    """Fill ``{page}`` and ``{per_page}``; any other braces stay as they are."""
    return template.replace("{page}", str(page)).replace("{per_page}", str(per_page))


_TRANSIENT = {429, 500, 502, 503, 504}


class Slots:
    """Send times of one task in a schedule that all tasks share.

    Slot ``i`` of the crawl is at ``start + i * interval``.  Lane ``k`` of ``n`` owns the
    slots k, k + n, k + 2n ... and sends one request per slot at most, so the crawl as a
    whole never exceeds one request per interval, whatever the number of tasks.  A
    page that needs no repeat goes out in the slot of its own number; a repeat
    takes a later slot of its lane (at least the backoff later), which moves the lane's
    later pages and nobody else's.
    """

    def __init__(self, start: float, interval: float, lane: int, lanes: int,
                 clock=time.time, sleep=time.sleep):
        self.start, self.interval, self.lane, self.lanes = start, interval, lane, lanes
        self.clock, self.sleep, self.turn = clock, sleep, 0

    def wait(self, backoff: float = 0.0) -> float:
        """Sleep until the lane's next free slot that is ``backoff`` away or more; returns its time."""
        now = self.clock()
        since = (now + backoff - self.start) / self.interval - self.lane
        # a slot that has just begun still counts (a clock is not exact to the last digit)
        self.turn = max(self.turn, math.ceil(since / self.lanes - 1e-9))
        at = self.start + (self.lane + self.turn * self.lanes) * self.interval
        self.turn += 1
        if at > now:
            self.sleep(at - now)
        return at


def fetch_with_retries(url: str, timeout: float = 30.0, retries: int = 2,
                       backoff: float = 1.0, fetch_fn=fetch, sleep=time.sleep, slots: Slots | None = None):
    """``fetch`` with bounded retries on transient outcomes.  With ``slots`` every attempt waits
    for a slot, a repeat for one that is the backoff away."""
    if slots:
        slots.wait()
    status, body = fetch_fn(url, timeout)
    for attempt in range(max(0, retries)):
        if status is not None and status not in _TRANSIENT:
            break
        if slots:
            slots.wait(backoff * (2 ** attempt))
        else:
            sleep(backoff * (2 ** attempt))
        status, body = fetch_fn(url, timeout)
    return status, body


def parse_ranges(text: str) -> list[tuple[int, int]]:
    """``"40-21,19"`` as (first, last) pairs."""
    out = []
    for part in filter(None, text.split(",")):
        lo, _, hi = part.partition("-")
        out.append((int(lo), int(hi or lo)))
    return out


def format_ranges(pages: list[int]) -> str:
    """Page numbers in crawl order as ranges; inverse of ``parse_ranges``."""
    runs: list[list[int]] = []
    for p in pages:
        step = p - runs[-1][1] if runs else 0
        if runs and abs(step) == 1 and (runs[-1][0] == runs[-1][1] or (runs[-1][1] > runs[-1][0]) == (step > 0)):
            runs[-1][1] = p
        else:
            runs.append([p, p])
    return ",".join(str(a) if a == b else f"{a}-{b}" for a, b in runs)


def range_pages(ranges: list[tuple[int, int]], lo: int, hi: int) -> list[int]:
    """The pages at the positions lo..hi-1 of the ranges."""
    out, at = [], 0
    for a, b in ranges:
        n, step = abs(b - a) + 1, 1 if b >= a else -1
        out += [a + step * i for i in range(max(0, lo - at), min(n, hi - at))]
        at += n
    return out


def _groups(n: int, k: int) -> list[tuple[int, int]]:
    """(offset, length) of ``n`` pages dealt to at most ``k`` groups of consecutive pages."""
    k = max(1, min(k, n))
    edges = [n * g // k for g in range(k + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


class PageLane(InputPartition):
    """The pages of one task (a range in batch reads), and their offsets in a stream."""

    def __init__(self, lane: int, lanes: int, start: float, pages, offsets=None):
        self.lane, self.lanes, self.start, self.pages, self.offsets = lane, lanes, start, pages, offsets


class _Fetcher:
    """What batch and stream readers share: options, and the rows of a task's pages."""

    def __init__(self, options):
        self.url = options["url"]
        self.first = int(options.get("first", 1))
        self.last = int(options.get("last", self.first))
        self.per_page = int(options.get("per_page", 200))
        self.per_file = int(options.get("pages_per_file", 1))
        self.pause = float(options.get("pause_seconds", 0))
        self.concurrency = int(options.get("concurrency", 1))
        self.rate = float(options.get("requests_per_second", 0))
        self.timeout = float(options.get("timeout_seconds", 30))
        self.retries = int(options.get("retries", 2))
        self.backoff = float(options.get("backoff_seconds", 1.0))

    def lanes(self, pages, offsets=None) -> list[PageLane]:
        """Pages dealt to tasks: in turn where a schedule sets the rate, else in runs."""
        k, start = max(1, min(self.concurrency, len(pages))), time.time()
        cut = ([slice(i, None, k) for i in range(k)] if self.rate > 0
               else [slice(at, at + n) for at, n in _groups(len(pages), k)])
        return [PageLane(i, k, start, pages[c], None if offsets is None else offsets[c]) for i, c in enumerate(cut)]

    def rows(self, lane: PageLane):
        slots = Slots(lane.start, 1 / self.rate, lane.lane, lane.lanes) if self.rate > 0 else None
        template = page_request_url(self.url, 0, self.per_page) if "{chunk}" in self.url else None
        chunk, status, held = None, None, {}
        for i, page in enumerate(lane.pages):
            if template is None:
                url, asked = page_request_url(self.url, page, self.per_page), True
                status, body = fetch_with_retries(url, self.timeout, self.retries, self.backoff, slots=slots)
                row = (page, url, status, body)
            else:
                url = template.replace("{chunk}", str(page // self.per_file))
                asked = url != chunk
                if asked:
                    chunk = url
                    status, text = fetch_with_retries(url, self.timeout, self.retries, self.backoff, slots=slots)
                    held = pages_of(text) if status == 200 else {}
                own, body = held.get(page, (404, None)) if status == 200 else (status, None)
                row = (page, url, own, body)
            yield row if lane.offsets is None else (lane.offsets[i], *row)
            if asked and self.pause > 0 and not slots:
                time.sleep(self.pause)


def pages_of(text: str | None) -> dict[int, tuple[int, str | None]]:
    """page -> (status, body) of the lines of an object of several pages; lines that are no page are skipped."""
    out = {}
    for line in (text or "").split("\n"):
        try:
            row = json.loads(line) if line else None
        except ValueError:
            row = None
        if isinstance(row, dict) and isinstance(row.get("page"), int):
            out[row["page"]] = (int(row.get("status") or 200), row.get("body"))
    return out


class PagedJsonReader(_Fetcher, DataSourceReader):
    def partitions(self):
        step = 1 if self.last >= self.first else -1
        return self.lanes(range(self.first, self.last + step, step))

    def read(self, partition):
        yield from self.rows(partition)


class PagedJsonStreamReader(_Fetcher, DataSourceStreamReader):
    """Offsets count requested pages: offset ``base + i`` is the i-th page of ``pages``."""

    def __init__(self, options):
        super().__init__(options)
        self.base = int(options.get("base", 0))
        self.named = parse_ranges(options.get("pages", f"{self.first}-{self.last}"))

    def initialOffset(self):
        return {"at": 0}

    def latestOffset(self):
        return {"at": self.base + sum(abs(b - a) + 1 for a, b in self.named)}

    def partitions(self, start, end):
        lo, hi = start["at"], end["at"]
        pages = range_pages(self.named, max(0, lo - self.base), hi - self.base)
        return self.lanes(pages, range(max(lo, self.base), hi)) if pages else []

    def read(self, partition):
        yield from self.rows(partition)


class PagedJsonSource(DataSource):
    @classmethod
    def name(cls):
        return "paged_json"

    def schema(self):
        return STREAM_SCHEMA if "pages" in self.options else SCHEMA

    def reader(self, schema):
        return PagedJsonReader(self.options)

    def streamReader(self, schema):
        return PagedJsonStreamReader(self.options)


def register(spark) -> None:
    """Register ``paged_json`` on the session.

    The module is pickled by value so Python workers need not import the
    package (it may be on the driver's path only).
    """
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(PagedJsonSource)


def read_pages(spark, url: str, first: int, last: int, per_page: int = 200,
               pause_seconds: float = 0.0, concurrency: int = 1,
               timeout_seconds: float = 30.0, retries: int = 2, backoff_seconds: float = 1.0,
               requests_per_second: float = 0.0, pages_per_file: int = 1):
    """DataFrame of page envelopes (S1; S1a is ``first == last``).

    Pages on a store that is neither the network nor a shared folder (``s3a://``,
    ``hdfs://`` ...) are read by Spark itself, with the session's endpoint and keys.
    """
    if urlparse(url).scheme not in ("", "file", "http", "https"):
        from strata.sources.page_files import read_page_files

        return read_page_files(spark, url, first, last, per_page, pages_per_file)
    register(spark)
    return (spark.read.format("paged_json")
            .option("url", url).option("first", first).option("last", last)
            .option("per_page", per_page).option("pause_seconds", pause_seconds)
            .option("concurrency", concurrency).option("timeout_seconds", timeout_seconds)
            .option("retries", retries).option("backoff_seconds", backoff_seconds)
            .option("requests_per_second", requests_per_second).option("pages_per_file", pages_per_file)
            .load())
