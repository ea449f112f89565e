"""The crawl as a stream, the shared request schedule, and pages read by Spark's file systems."""

import json
import os
import random

import pytest

from strata.plans.api_job import crawl_pages, run_api_medallion
from strata.sources.page_files import read_page_files
from strata.sources.paged_json import (PagedJsonReader, PagedJsonStreamReader, Slots, fetch_with_retries, format_ranges,
                                       page_url, pages_of, parse_ranges, range_pages, read_pages)
from strata.streaming.crawl_stream import CrawlStore, crawl_key

REC = "id string, kind string"


def write_page(root, n, body):
    d = os.path.join(root, f"page={n}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "part-0.txt"), "w") as fh:
        fh.write((body if isinstance(body, str) else json.dumps(body)) + "\n")


def record(n):
    return [{"id": f"{n}", "kind": f"k{n % 2}"}]


@pytest.fixture()
def site(tmp_path):
    root = str(tmp_path / "site")
    for n in range(1, 11):
        write_page(root, n, record(n))
    return root


# ---- stream --------------------------------------------------------------

def asked(crawl):
    return [r.page for r in crawl.requests().orderBy("at").collect()]


def test_stop_and_restart_fetches_each_page_once(spark, tmp_path, site):
    def store():
        return CrawlStore(spark, str(tmp_path / "store"), page_url(site))

    assert store().run(10, 5, pages_per_batch=4, concurrency=2) == 6
    assert sorted(asked(store())) == [5, 6, 7, 8, 9, 10]
    assert store().run(10, 1, pages_per_batch=4, concurrency=2) == 4
    assert sorted(asked(store())) == list(range(1, 11))
    assert store().run(10, 1) == 0                       # nothing is left to ask for
    assert [r.at for r in store().requests().orderBy("at").collect()] == list(range(10))


def test_failed_pages_come_again_and_good_ones_do_not(spark, tmp_path, site):
    os.remove(os.path.join(site, "page=3", "part-0.txt"))
    write_page(site, 7, "<html>")
    crawl = CrawlStore(spark, str(tmp_path / "store"), page_url(site))
    crawl.run(10, 1)
    write_page(site, 3, record(3))
    write_page(site, 7, record(7))
    assert crawl.run(10, 1) == 2 and asked(crawl)[10:] == [7, 3]
    pages = {r.page: r.status for r in crawl.pages(10, 1).collect()}
    assert pages == {n: 200 for n in range(1, 11)}
    assert crawl.run(10, 1) == 0
    # a page that fails later does not replace the good one that is stored
    assert crawl.pages(4, 3).count() == 2


def test_a_batch_cut_short_is_finished_first(spark, tmp_path, site, monkeypatch):
    crawl = CrawlStore(spark, str(tmp_path / "store"), page_url(site))
    crawl.run(10, 7, pages_per_batch=4)

    def cut(plan, options):
        raise KeyboardInterrupt

    monkeypatch.setattr(crawl, "_batch", cut)
    with pytest.raises(KeyboardInterrupt):
        crawl.run(10, 1, pages_per_batch=4)
    monkeypatch.undo()
    crawl.run(10, 1, pages_per_batch=4)
    assert asked(crawl) == list(range(10, 0, -1))


def test_a_store_serves_several_templates(spark, tmp_path, site):
    other = str(tmp_path / "other")
    write_page(other, 1, [{"id": "other", "kind": "o"}])
    store = str(tmp_path / "store")
    a = crawl_pages(spark, page_url(site), 1, 1, store=store).collect()
    b = crawl_pages(spark, page_url(other), 1, 1, store=store).collect()
    assert "other" in b[0].body and "other" not in a[0].body
    assert crawl_key("u", 200) != crawl_key("u", 100)


def test_a_stored_failure_is_not_final(spark, tmp_path):
    site, store = str(tmp_path / "late"), str(tmp_path / "store")
    os.makedirs(site)
    assert crawl_pages(spark, page_url(site), 1, 1, store=store).collect()[0].status == 404
    write_page(site, 1, record(1))
    assert crawl_pages(spark, page_url(site), 1, 1, store=store).collect()[0].status == 200


def test_stream_offsets_are_request_numbers():
    r = PagedJsonStreamReader({"url": "u{page}", "pages": "9-7,3", "base": "5", "concurrency": "2"})
    assert r.initialOffset() == {"at": 0} and r.latestOffset() == {"at": 9}
    lanes = r.partitions({"at": 5}, {"at": 9})
    assert [(a, p) for lane in lanes for a, p in zip(lane.offsets, lane.pages)] == [(5, 9), (6, 8), (7, 7), (8, 3)]
    lanes = r.partitions({"at": 7}, {"at": 9})
    assert [p for lane in lanes for p in lane.pages] == [7, 3]
    assert r.partitions({"at": 2}, {"at": 5}) == []      # requests before the plan are not repeated


def test_ranges_round_trip():
    r = random.Random(4)
    for _ in range(200):
        pages = [r.randint(1, 9) for _ in range(r.randint(0, 12))]
        ranges = parse_ranges(format_ranges(pages))
        assert range_pages(ranges, 0, len(pages)) == pages
        lo = r.randint(0, len(pages))
        assert range_pages(ranges, lo, len(pages)) == pages[lo:]
    assert format_ranges([40, 39, 38, 7]) == "40-38,7"


# ---- an empty crawl ------------------------------------------------------

def test_an_all_empty_crawl_does_not_empty_a_good_lake(spark, tmp_path, site):
    lake = str(tmp_path / "lake")
    args = dict(record_schema=REC, partition_by=["kind"], group_by=["kind"], first=10, last=1, pause_seconds=0)
    good = run_api_medallion(spark, page_url(site), lake, **args)
    assert good.counts["silver"] == 10
    empty = str(tmp_path / "empty")
    for n in range(1, 11):
        write_page(empty, n, [])
    with pytest.raises(RuntimeError, match="no records"):
        run_api_medallion(spark, page_url(empty), lake, **args)
    assert good.silver.count() == 10
    first = run_api_medallion(spark, page_url(empty), str(tmp_path / "new"), **args)   # a first run may be empty
    assert first.counts == {"bronze": 0, "silver": 0, "gold": 0}
    assert run_api_medallion(spark, page_url(empty), lake, allow_empty=True, **args).counts["silver"] == 0


def test_a_lost_page_is_named_where_the_id_is_a_number(spark, tmp_path, site):
    os.remove(os.path.join(site, "page=2", "part-0.txt"))
    lake = str(tmp_path / "lake")
    with pytest.raises(RuntimeError, match="1 pages of the crawl failed"):
        run_api_medallion(spark, page_url(site), lake, first=3, last=1, pause_seconds=0, record_schema="id long, kind string",
                          partition_by=["kind"], group_by=["kind"])
    assert [r.page_url for r in spark.read.json(f"{lake}/failed_pages").collect()] == [page_url(site).format(page=2)]


def test_api_job_publishes_and_refuses_drift(spark, tmp_path, site):
    from strata.plans.drift import DriftError

    lake = str(tmp_path / "lake")
    args = dict(record_schema=REC, partition_by=["kind"], group_by=["kind"], first=10, last=1, pause_seconds=0,
                publish_runs=True, on_drift="refuse", store=str(tmp_path / "store"))
    assert run_api_medallion(spark, page_url(site), lake, **args).counts["gold"] == 2
    changed = str(tmp_path / "changed")
    for n in range(1, 11):
        write_page(changed, n, [{"id": n, "kind": {"a": 1}}])
    before = sorted(os.listdir(f"{lake}/runs"))
    with pytest.raises(DriftError, match="kind: conflict"):
        run_api_medallion(spark, page_url(changed), lake, **args)
    assert sorted(os.listdir(f"{lake}/runs")) == before          # bronze was not touched


# ---- one request schedule ------------------------------------------------

class Clock:
    def __init__(self):
        self.now = 100.0

    def __call__(self):
        return self.now

    def sleep(self, s):
        self.now += s


@pytest.mark.parametrize("tasks", [1, 4, 16])
def test_tasks_share_one_rate(tasks):
    r, sent, rate = random.Random(tasks), [], 5.0
    lanes = PagedJsonReader({"url": "u{page}", "first": "1", "last": "200", "concurrency": str(tasks),
                             "requests_per_second": str(rate)}).partitions()
    assert sorted(p for lane in lanes for p in lane.pages) == list(range(1, 201)) and len(lanes) == tasks
    first = {}
    for lane in lanes:                                   # lanes run apart; times are put together afterwards
        clock = Clock()
        clock.now += r.choice([0, 0, 3.3])               # a task may start late
        slots = Slots(100.0, 1 / rate, lane.lane, lane.lanes, clock, clock.sleep)
        for page in lane.pages:
            def answer(url, timeout):
                sent.append(clock.now)
                first.setdefault(page, clock.now)
                clock.now += r.choice([0.01, 0.05, 1.0])          # time the request takes
                return (503, None) if r.random() < 0.1 else (200, "[]")
            fetch_with_retries("u", retries=2, backoff=0.7, fetch_fn=answer, slots=slots)
    sent.sort()
    gaps = [b - a for a, b in zip(sent, sent[1:])]
    assert min(gaps) >= 1 / rate - 1e-6                  # never two requests within one slot
    assert len(first) == 200


def test_pages_go_out_in_the_slots_of_their_numbers():
    for tasks in (1, 4):
        lanes = PagedJsonReader({"url": "u", "first": "0", "last": "19", "concurrency": str(tasks),
                                 "requests_per_second": "2"}).partitions()
        at = {}
        for lane in lanes:
            clock = Clock()
            slots = Slots(100.0, 0.5, lane.lane, lane.lanes, clock, clock.sleep)
            for p in lane.pages:
                at[p] = slots.wait()
        assert at == pytest.approx({p: 100.0 + 0.5 * p for p in range(20)})


def test_backoff_moves_later_slots_of_the_lane():
    clock = Clock()
    slots = Slots(100.0, 1.0, 1, 4, clock, clock.sleep)
    assert [slots.wait(), slots.wait(6.0), slots.wait()] == [101.0, 109.0, 113.0]


# ---- pages of a file store -----------------------------------------------

def test_page_files_statuses(spark, site):
    write_page(site, 2, "é\n")
    with open(os.path.join(site, "page=3", "part-1.txt"), "w") as fh:
        fh.write("[]")
    with open(os.path.join(site, "page=4", "part-0.txt"), "wb") as fh:
        fh.write(b"\xff\xfe")
    os.remove(os.path.join(site, "page=5", "part-0.txt"))
    got = {r.page: (r.status, r.body) for r in read_page_files(spark, page_url(site), 11, 1).collect()}
    want = {r.page: (r.status, r.body) for r in read_pages(spark, page_url(site), 11, 1).collect()}
    assert got == want
    assert got[2] == (200, "é") and got[3] == (500, None) and got[4] == (200, None)
    assert got[5] == got[11] == (404, None) and json.loads(got[10][1]) == record(10)


def test_grouped_pages(spark, tmp_path):
    root = str(tmp_path / "grouped")
    os.makedirs(f"{root}/chunk=0")
    os.makedirs(f"{root}/chunk=1")
    with open(f"{root}/chunk=0/part-0.txt", "w") as fh:
        for n in (1, 2, 3):
            fh.write(json.dumps({"page": n, "body": json.dumps(record(n))}) + "\n")
        fh.write("not a page\n")
    with open(f"{root}/chunk=1/part-0.txt", "w") as fh:
        fh.write(json.dumps({"page": 5, "status": 503, "body": None}) + "\n")
    url = page_url(root, "chunk")
    for read in (read_pages, read_page_files):
        got = {r.page: (r.status, r.body) for r in read(spark, url, 9, 1, pages_per_file=4).collect()}
        assert [got[n][0] for n in range(1, 10)] == [200, 200, 200, 404, 503, 404, 404, 404, 404]
        assert json.loads(got[2][1]) == record(2) and got[5][1] is None
    assert pages_of('{"page": 1}\n[]\n{"page": "x"}') == {1: (200, None)}


def test_settings_reach_the_page_reader(spark, site):
    """A file system that only the session's settings name serves the pages."""
    spark.conf.set("fs.viewfs.mounttable.shop.link./api", "file://" + site)
    try:
        got = read_pages(spark, "viewfs://shop/api/page={page}", 3, 1).collect()
        assert {r.page: r.status for r in got} == {1: 200, 2: 200, 3: 200}
    finally:
        spark.conf.unset("fs.viewfs.mounttable.shop.link./api")
