"""The whole job over a folder of API page bodies (FIXTURES.md A1 fixtures)."""

import json
import os

import pytest

from strata.functions.schemas import BREWERY_FIELDS
from strata.plans.api_job import run_api_medallion


def _rec(i, state="California", btype="micro", **kw):
    d = {f: f"{f}-{i}" for f in BREWERY_FIELDS}
    d.update(id=f"b{i}", state_province=state, brewery_type=btype, longitude="-1.5", latitude=2.5)
    d.update(kw)
    return d


@pytest.fixture()
def pages(tmp_path):
    bodies = {
        6: [_rec(1), _rec(2), _rec(3, btype="brewpub")],                       # page_full
        5: [_rec(4, state="New York", address_2=None), _rec(5, state="New York")],  # page_nulls
        4: [_rec(6, state="Oregon", geo={"a": 1}, tags=["x"])],               # page_nested/extra
        3: [],                                                                 # page_empty
        2: {"message": "error"},                                               # error object
        1: "<<not json>>",                                                     # page_bad_text
    }
    for n, body in bodies.items():
        d = tmp_path / "api" / f"page={n}"
        d.mkdir(parents=True)
        text = body if isinstance(body, str) else json.dumps(body)
        (d / "part-00000.txt").write_text(text + "\n")
    return "file://" + str(tmp_path / "api") + "/page={page}"


def test_api_job_end_to_end(spark, tmp_path, pages):
    root = str(tmp_path / "lake")
    res = run_api_medallion(spark, pages, root, first=7, last=1, pause_seconds=0, concurrency=3,
                            allow_incomplete=True)
    # 6 records + page 2's error object (one all-null record); record 4 has a
    # null address_2 and the error object is all null -> 5 complete rows
    assert res.counts["bronze"] == 5
    got = {(r.state_province, r.brewery_type): r["count"] for r in res.gold.collect()}
    assert got == {("California", "micro"): 2, ("California", "brewpub"): 1,
                   ("New York", "micro"): 1, ("Oregon", "micro"): 1}
    assert dict(res.silver.dtypes)["longitude"] == "double"
    audit = spark.read.json(os.path.join(root, "failed_pages"))
    # page 7 missing (404), 3 empty, 1 unparsable; page 2's lone error object is
    # one record with every field null, so it is dropped as incomplete instead.
    assert sorted(r.id.rsplit("=", 1)[1] for r in audit.collect()) == ["1", "3", "7"]


def test_crawl_records_in_crawl_order(spark, tmp_path, pages):
    from strata.plans.api_job import crawl_order

    res = run_api_medallion(spark, pages, str(tmp_path / "lake"), first=7, last=1,
                            pause_seconds=0, concurrency=3, allow_incomplete=True)
    head = res.records.orderBy(*crawl_order(7, 1)).limit(4).collect()
    assert [(r.page, r.position, r.id) for r in head] == [
        (6, 0, "b1"), (6, 1, "b2"), (6, 2, "b3"), (5, 0, "b4")]


def test_api_job_inline_sentinels_dropped(spark, tmp_path, pages):
    res = run_api_medallion(spark, pages, str(tmp_path / "lake"), first=7, last=1,
                            pause_seconds=0, failed_pages="inline", allow_incomplete=True)
    assert res.counts["bronze"] == 5          # sentinel rows are incomplete -> dropped (P3)


def test_api_job_keeps_sentinels_without_drop(spark, tmp_path, pages):
    res = run_api_medallion(spark, pages, str(tmp_path / "lake"), first=7, last=1,
                            pause_seconds=0, failed_pages="inline", drop_incomplete_at=None,
                            allow_incomplete=True)
    assert res.counts["bronze"] == 6 + 1 + 3  # 6 records, the error object, 3 sentinels
    null_group = [r["count"] for r in res.gold.collect() if r.state_province is None]
    assert null_group == [4]


def test_cli_runs_job_on_active_session(spark, tmp_path, pages):
    from strata.cli import main

    counts = main(["medallion", "--url", pages, "--root", str(tmp_path / "lake"), "--first", "7", "--last", "1",
                   "--pause-seconds", "0", "--concurrency", "2", "--preview", "0",
                   "--preview-crawl", "3", "--allow-incomplete"])
    assert counts == {"bronze": 5, "silver": 5, "gold": 4}
    assert spark.range(1).count() == 1           # the caller's session is left running


def test_cli_distribution_check(spark, tmp_path):
    from strata.cli import main

    assert main(["partitions", "--rows", "10000", "--partitions", "4"]) == [
        (0, 2500), (1, 2500), (2, 2500), (3, 2500)]
    path = str(tmp_path / "t")
    spark.range(0, 1000).write.parquet(path)
    got = main(["partitions", "--table", path])
    assert sum(c for _, c in got) == 1000


def _bytes(root):
    return {os.path.join(d, n): open(os.path.join(d, n), "rb").read()
            for layer in ("bronze", "silver", "gold")
            for d, _, names in os.walk(os.path.join(root, layer)) for n in names}


def test_failed_crawl_leaves_the_layers(spark, tmp_path, pages):
    root = str(tmp_path / "lake")
    run_api_medallion(spark, pages, root, first=6, last=3, pause_seconds=0)   # page 3 is empty: no failure
    before = _bytes(root)
    assert before
    lost = str(tmp_path / "none" / "{page}.json")
    for url, first, last in ((lost, 3, 1), (pages, 7, 4), (pages, 6, 1), ("nosuch://x/{page}", 2, 1)):
        with pytest.raises(RuntimeError, match="pages of the crawl failed"):
            run_api_medallion(spark, url, root, first=first, last=last, pause_seconds=0)
        assert _bytes(root) == before
    with pytest.raises(RuntimeError):                     # nothing is left to go on with
        run_api_medallion(spark, lost, root, first=3, last=1, pause_seconds=0, allow_incomplete=True)
    assert _bytes(root) == before
    audit = {r.id for r in spark.read.json(os.path.join(root, "failed_pages")).collect()}
    assert any(u.endswith("page=7") for u in audit) and "nosuch://x/1" in audit


def test_api_job_rescues_unknown_keys(spark, tmp_path, pages):
    import json as _json

    res = run_api_medallion(spark, pages, str(tmp_path / "lake"), first=7, last=1,
                            pause_seconds=0, rescue_col="_rescued", allow_incomplete=True)
    assert res.counts["bronze"] == 5                      # unknown keys do not empty the table
    b6 = res.silver.filter("id = 'b6'").first()
    assert set(_json.loads(b6._rescued)) == {"geo", "tags"}
    assert res.silver.filter("_rescued IS NULL").count() == 4


def _pages(tmp_path, bodies):
    for n, body in bodies.items():
        d = tmp_path / "own" / f"page={n}"
        d.mkdir(parents=True, exist_ok=True)
        (d / "part-00000.txt").write_text(json.dumps(body) + "\n")
    return "file://" + str(tmp_path / "own") + "/page={page}"


def test_dirty_coordinate_survives_to_bronze(spark, tmp_path):
    url = _pages(tmp_path, {1: [_rec(1), _rec(2, longitude="n/a")]})
    root = str(tmp_path / "lake")
    res = run_api_medallion(spark, url, root, first=1, last=1, pause_seconds=0)
    assert res.counts == {"bronze": 2, "silver": 2, "gold": 1}
    assert {r.longitude for r in spark.read.json(root + "/bronze").collect()} == {"-1.5", "n/a"}
    assert {r.longitude for r in res.silver.collect()} == {-1.5, None}


NESTED = {2: [{"key": 1, "geo": {"state": "a", "lat": "1.5"}}, {"key": 2, "geo": {"state": "b", "lat": "x"}}],
          1: {"key": 3, "geo": {"state": "a", "lat": "2"}}}


@pytest.mark.parametrize("schema", [None, "key BIGINT, geo STRUCT<state: STRING, lat: STRING>"])
def test_any_record_schema(spark, tmp_path, schema):
    url = _pages(tmp_path, NESTED)
    res = run_api_medallion(spark, url, str(tmp_path / "lake"), first=2, last=1, pause_seconds=0,
                            record_schema=schema, id_field="key", partition_by=["geo.state"],
                            group_by=["geo.state"], casts={"geo.lat": "DOUBLE"})
    assert {tuple(r) for r in res.gold.collect()} == {("a", 2), ("b", 1)}
    assert {tuple(r) for r in res.silver.select("key", "`geo.state`", "`geo.lat`").collect()} == {
        (1, "a", 1.5), (2, "b", None), (3, "a", 2.0)}


def test_inline_sentinels_of_nested_records(spark, tmp_path):
    url = _pages(tmp_path, NESTED)
    res = run_api_medallion(spark, url, str(tmp_path / "lake"), first=3, last=1, pause_seconds=0,
                            record_schema="key STRING, geo STRUCT<state: STRING, lat: STRING>", id_field="key",
                            partition_by=["geo.state"], group_by=["geo.state"], failed_pages="inline",
                            allow_incomplete=True)
    assert sorted(res.silver.columns) == ["geo.lat", "geo.state", "key"]
    assert res.counts["bronze"] == 3


def test_records_without_a_declared_field_stop_the_job(spark, tmp_path):
    url = _pages(tmp_path, {1: [{"other": i} for i in range(50)]})
    root = str(tmp_path / "lake")
    with pytest.raises(RuntimeError, match="declared fields"):
        run_api_medallion(spark, url, root, first=1, last=1, pause_seconds=0)
    assert not os.path.exists(root + "/bronze")


def test_stored_page_groups_are_not_fetched_again(spark, tmp_path):
    from strata.plans.api_job import crawl_pages

    url, store = _pages(tmp_path, {n: [{"id": "old"}] for n in range(6, 0, -1)}), str(tmp_path / "store")
    crawl_pages(spark, url, 6, 4, pages_per_task=3, store=store)
    _pages(tmp_path, {n: [{"id": "new"}] for n in range(6, 0, -1)})
    env = crawl_pages(spark, url, 6, 1, pages_per_task=3, store=store)
    assert {r.page: "old" in r.body for r in env.collect()} == {
        6: True, 5: True, 4: True, 3: False, 2: False, 1: False}


def test_text_that_is_not_utf8_is_a_failed_page(spark, tmp_path):
    from strata.sources.paged_json import fetch

    path = tmp_path / "page.json"
    path.write_bytes(b'["\xff"]')
    assert fetch(f"file://{path}") == (200, None)
