"""Runs published at once, and gold kept by signed counts."""

import json

import pytest
from pyspark.sql import functions as F

from strata.plans import maintained_gold as mg
from strata.plans import medallion
from strata.plans.maintained_gold import MaintainedGold
from strata.plans.medallion import MedallionParams
from strata.plans.publish import PublishConflict, RunFolders, open_layers, published, run_published

SCHEMA = "id long, state string, kind string"


def rows(spark, n, state="a"):
    return spark.createDataFrame([(i, state if i % 3 else "b", f"k{i % 2}") for i in range(n)], SCHEMA)


@pytest.fixture()
def params(tmp_path):
    return MedallionParams(root=str(tmp_path / "lake"), partition_by=["state"], group_by=["state", "kind"])


def counts(df):
    return {(r.state, r.kind): r["count"] for r in df.collect()}


@pytest.mark.parametrize("layer", ["silver", "gold"])
def test_a_run_that_is_killed_leaves_the_old_layers_whole(spark, params, monkeypatch, layer):
    first = rows(spark, 30)
    run_published(spark, first, params)
    before = RunFolders(spark, params.root).current()
    want = counts(open_layers(spark, params, first.schema)["gold"])
    write = medallion.write_table

    def killed(df, path, *a, **kw):
        if path.endswith("/" + layer):
            raise KeyboardInterrupt
        return write(df, path, *a, **kw)

    monkeypatch.setattr(medallion, "write_table", killed)
    with pytest.raises(KeyboardInterrupt):
        run_published(spark, rows(spark, 9, "new"), params)
    monkeypatch.setattr(medallion, "write_table", write)
    assert RunFolders(spark, params.root).current() == before
    layers = open_layers(spark, params, first.schema)
    assert counts(layers["gold"]) == want
    assert layers["bronze"].count() == 30 and layers["silver"].count() == 30


def test_a_reader_that_is_open_sees_one_run(spark, params):
    run_published(spark, rows(spark, 30), params)
    layers = open_layers(spark, params, rows(spark, 1).schema)
    res = run_published(spark, rows(spark, 12, "new"), params, keep=1)
    assert layers["silver"].count() == 30 and layers["bronze"].count() == 30
    assert sum(counts(layers["gold"]).values()) == 30 and res.counts["silver"] == 12
    assert open_layers(spark, params, rows(spark, 1).schema)["silver"].count() == 12


def test_retire_keeps_the_current_run_and_newer_folders(spark, params):
    for n in (3, 6, 9):
        run_published(spark, rows(spark, n), params)
    folders = RunFolders(spark, params.root)
    names = folders.store.names(f"{params.root}/runs")
    assert len(names) == 3 and names[-1] == folders.current()
    late = folders.new()
    rows(spark, 1).write.parquet(folders.path(late))
    assert folders.retire(keep=1) == names[:1]
    assert folders.store.names(f"{params.root}/runs") == [*names[1:], late]
    assert published(spark, params).root.endswith(names[-1])


def test_a_second_writer_is_refused(spark, params):
    run_published(spark, rows(spark, 3), params)
    folders = RunFolders(spark, params.root)
    since = folders.current()
    run_published(spark, rows(spark, 6), params)
    with pytest.raises(PublishConflict):
        folders.publish(folders.new(), since)


def test_publishing_needs_whole_layers(spark, params):
    with pytest.raises(FileNotFoundError):
        published(spark, params)
    for change in ({"dynamic_silver": True}, {"silver_mode": "append"}):
        with pytest.raises(ValueError):
            run_published(spark, rows(spark, 3), MedallionParams(
                root=params.root, partition_by=["state"], group_by=["state"], **change))


# ---- gold by signed counts -----------------------------------------------

def gold_at(spark, tmp_path):
    return MaintainedGold(spark, str(tmp_path / "lake"), rows(spark, 1).schema, ["state"], ["state", "kind"])


def full(df):
    return counts(df.groupBy("state", "kind").count())


def test_three_batches_equal_a_full_count(spark, tmp_path):
    gold = gold_at(spark, tmp_path)
    one = rows(spark, 40).unionByName(spark.createDataFrame([(90, None, "k"), (91, "", "k"), (92, "~", None)], SCHEMA))
    assert gold.apply("one", one) is True
    assert gold.apply("one", rows(spark, 5)) is False            # a repeated batch is not looked at
    assert counts(gold.gold()) == full(one)
    fix = spark.createDataFrame([(1, "a", "k9"), (2, None, "k9"), (3, "", "k8")], SCHEMA)
    gold.apply("two", fix)
    whole = one.filter("state not in ('a', '') and state is not null").unionByName(fix)
    assert counts(gold.gold()) == full(whole) == full(gold.silver())
    gold.apply("three", spark.createDataFrame([(7, "c", "k0")], SCHEMA))
    assert counts(gold.gold()) == {**full(whole), ("c", "k0"): 1}


def test_only_landed_partitions_are_scanned(spark, tmp_path):
    gold = gold_at(spark, tmp_path)
    gold.apply("one", rows(spark, 40))
    plan = gold.delta(spark.createDataFrame([(1, "a", "k")], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("PartitionFilters: [" in x and "PartitionFilters: []" not in x for x in scans)


@pytest.mark.parametrize("step", ["delta", "silver", "gold", "VERSION", "GOLD"])
def test_a_batch_cut_short_is_finished_from_its_stored_rows(spark, tmp_path, monkeypatch, step):
    gold = gold_at(spark, tmp_path)
    gold.apply("one", rows(spark, 40))
    fix = spark.createDataFrame([(1, "a", "k9"), (2, "c", "k9")], SCHEMA)
    write, swap = mg.write_table, gold.store.replace

    def cut(df, path, *a, **kw):
        write(df, path, *a, **kw)
        if f"/{step}" in path:
            raise KeyboardInterrupt

    def cut_swap(path, text):
        if path.endswith(f"/{step}"):
            raise KeyboardInterrupt
        swap(path, text)

    monkeypatch.setattr(mg, "write_table", cut)
    monkeypatch.setattr(gold.store, "replace", cut_swap)
    with pytest.raises(KeyboardInterrupt):
        gold.apply("two", fix)
    monkeypatch.undo()
    assert counts(gold.gold()) == full(rows(spark, 40))          # readers see the version before
    with pytest.raises(RuntimeError, match="unfinished"):
        gold.apply("three", rows(spark, 2))
    assert gold.apply("two", rows(spark, 0)) is True             # its rows are stored
    want = {**full(rows(spark, 40).filter("state <> 'a'")), ("a", "k9"): 1, ("c", "k9"): 1}
    assert counts(gold.gold()) == want == full(gold.silver())


def test_keys_that_empty_out_leave_gold(spark, tmp_path):
    gold = gold_at(spark, tmp_path)
    assert gold.gold().collect() == [] and gold.silver().collect() == []
    gold.apply("one", spark.createDataFrame([(1, "a", "x"), (2, "a", "y")], SCHEMA))
    gold.apply("two", spark.createDataFrame([(1, "a", "x")], SCHEMA))
    assert counts(gold.gold()) == {("a", "x"): 1}
    with pytest.raises(ValueError):
        gold.apply("../x", rows(spark, 1))
    assert json.loads(gold.store.read_text(f"{gold.root}/GOLD"))["version"] == 2


def test_two_partition_columns(spark, tmp_path):
    gold = MaintainedGold(spark, str(tmp_path / "m"), rows(spark, 1).schema, ["state", "kind"], ["kind"])
    gold.apply("one", rows(spark, 40))
    gold.apply("two", spark.createDataFrame([(1, "a", "k0")], SCHEMA))
    want = rows(spark, 40).filter("not (state = 'a' and kind = 'k0')").groupBy("kind").count().collect()
    got = {r.kind: r["count"] for r in gold.gold().collect()}
    assert got == {r.kind: r["count"] + (r.kind == "k0") for r in want}
    assert gold.silver().filter(F.col("state") == "a").filter("kind = 'k0'").count() == 1
