"""S1 over a folder of page bodies (no network), with P1/P4 downstream."""

import json
import os

from pyspark.sql import functions as F

from strata.functions.schemas import BREWERY_SCHEMA
from strata.operators.routing import route_pages
from strata.operators.sequence import with_sequence
from strata.sources.paged_json import _groups, fetch, read_pages


def _rec(i, **kw):
    d = {f: f"{f}-{i}" for f in BREWERY_SCHEMA.fieldNames()}
    d["id"] = str(i)
    d.update(kw)
    return d


def _write_pages(root, pages):
    for n, body in pages.items():
        d = os.path.join(root, f"page={n}")
        os.makedirs(d)
        with open(os.path.join(d, "part-00000.txt"), "w") as fh:
            fh.write(body + "\n")


def test_fetch_file_transport(tmp_path):
    _write_pages(str(tmp_path), {1: "[]"})
    assert fetch(f"file://{tmp_path}/page=1") == (200, "[]")
    assert fetch(f"file://{tmp_path}/page=2") == (404, None)


def test_groups_cover_pages_in_order():
    gs = _groups(40, 6)
    assert len(gs) == 6 and [at + i for at, n in gs for i in range(n)] == list(range(40))
    assert _groups(1, 8) == [(0, 1)]


def test_crawl_routes_and_orders(spark, tmp_path):
    root = str(tmp_path)
    _write_pages(root, {
        4: json.dumps([_rec(1), _rec(2)]),
        3: json.dumps([_rec(3, extra_key="x"), _rec(4, geo={"lat": 1})]),   # unknown keys ignored
        2: "[]",                                                            # empty page
        1: "<html>oops</html>",                                             # bad text
    })
    env = read_pages(spark, "file://" + root + "/page={page}", first=5, last=1, concurrency=3)
    assert env.rdd.getNumPartitions() == 3
    rows = {r.page: (r.status, r.url) for r in env.collect()}
    assert rows[5][0] == 404 and rows[4][0] == 200 and rows[4][1].endswith("page=4")
    records, sentinels = route_pages(env, BREWERY_SCHEMA)
    got = records.select("page", "position", "id").collect()
    assert sorted((r.page, r.position, r.id) for r in got) == [(3, 0, "3"), (3, 1, "4"),
                                                                (4, 0, "1"), (4, 1, "2")]
    assert sorted(r.id for r in sentinels.collect()) == sorted(
        "file://" + root + f"/page={n}" for n in (1, 2, 5))
    # crawl order: page descending (first fetched first), then position
    seq = with_sequence(records, [F.col("page").desc(), F.col("position")], "seq")
    assert [r.id for r in seq.orderBy("seq").collect()] == ["1", "2", "3", "4"]


def test_single_page_fetch(spark, tmp_path):
    _write_pages(str(tmp_path), {46: json.dumps([_rec(9)])})
    env = read_pages(spark, "file://" + str(tmp_path) + "/page={page}", first=46, last=46)
    assert [(r.page, r.status) for r in env.collect()] == [(46, 200)]


def test_pause_is_per_task(spark, tmp_path):
    import time

    _write_pages(str(tmp_path), {n: "[]" for n in range(1, 5)})
    t0 = time.time()
    read_pages(spark, "file://" + str(tmp_path) + "/page={page}", first=4, last=1,
               pause_seconds=0.5, concurrency=1).collect()
    assert time.time() - t0 >= 2.0


def test_retries_transient_then_gives_up():
    from strata.sources.paged_json import fetch_with_retries

    answers = iter([(None, None), (503, "busy"), (200, "[]")])
    waits = []
    got = fetch_with_retries("u", retries=2, backoff=0.5, fetch_fn=lambda u, t: next(answers),
                             sleep=waits.append)
    assert got == (200, "[]") and waits == [0.5, 1.0]
    always = fetch_with_retries("u", retries=1, fetch_fn=lambda u, t: (500, None), sleep=lambda s: None)
    assert always == (500, None)
    no_retry = fetch_with_retries("u", retries=3, fetch_fn=lambda u, t: (404, None),
                                  sleep=lambda s: (_ for _ in ()).throw(AssertionError("slept")))
    assert no_retry == (404, None)


def test_page_url_forms(tmp_path):
    from strata.sources.paged_json import page_url

    assert page_url("/data/p") == "file:///data/p/page={page}"
    assert page_url("file:/data/p/") == "file:///data/p/page={page}"
    assert page_url("s3a://bucket/p") == "s3a://bucket/p/page={page}"
    _write_pages(str(tmp_path), {2: "[1]"})
    assert fetch(page_url("file:" + str(tmp_path)).format(page=2)) == (200, "[1]")
    # another scheme goes through pyarrow's file systems (its empty mock one here)
    assert fetch("mock://nowhere/page=1") == (404, None)
    assert fetch("nosuchscheme://x/page=1") == (None, None)


def test_page_request_url_keeps_other_braces():
    from strata.sources.paged_json import page_request_url

    t = 'https://api.example/items?page={page}&per_page={per_page}&filter={"a":1}'
    assert page_request_url(t, 40, 200) == 'https://api.example/items?page=40&per_page=200&filter={"a":1}'
