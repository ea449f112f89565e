"""Partition values, missing-value costs, file layout, drift, the once-only log and nearest vectors."""

import itertools
import os
from urllib.parse import unquote

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators.cleansing import drop_incomplete
from strata.operators.layout import block_layout, file_layout, folder_layout, layout_summary
from strata.operators.missing import emptying_columns, missing_costs, missing_masks
from strata.operators.vector_topk import top_k
from strata.plans.drift import DriftError, SchemaHistory, drift, fields, join_kinds, merged, profile
from strata.plans.medallion import MedallionParams, run_medallion
from strata.sinks.files import OnceLog, publish_single_object, write_table
from strata.sinks.partition_codec import decoded, encoded
from strata.sinks.store import Store, scan_roots
from strata.sources.files import read_table

VALUES = ["", None, "01", "1", "a/b", "a:b", "~", "~~", "~x", "é %=", "__HIVE_DEFAULT_PARTITION__x", " ", "plain"]


# ---- partition values ----------------------------------------------------

def test_partition_values_round_trip_and_prune(spark, tmp_path):
    df = spark.createDataFrame([(i, v, i % 2) for i, v in enumerate(VALUES * 3)], "id long, v string, n int")
    path = str(tmp_path / "t")
    write_table(encoded(df, ["v", "n"]), path, partition_by=["v", "n"], mode="overwrite")
    back = decoded(read_table(spark, path, schema=df.schema), ["v", "n"]).select("id", "v", "n")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    for value in VALUES:
        hit = back.filter(F.col("v").eqNullSafe(value))
        assert sorted(r.id for r in hit.collect()) == [i for i, v in enumerate(VALUES * 3) if v == value]
        plan = hit._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: []" not in plan and "PartitionFilters: [" in plan


def test_flow_keeps_empty_and_missing_apart(spark, tmp_path):
    df = spark.createDataFrame([(1, "", "x"), (2, None, "x"), (3, "~", "x")], "id long, state string, kind string")
    p = MedallionParams(root=str(tmp_path / "m"), partition_by=["state"], group_by=["state"], drop_incomplete_at=None)
    res = run_medallion(spark, df, p)
    assert {(r.state, r["count"]) for r in res.gold.collect()} == {("", 1), (None, 1), ("~", 1)}
    assert {r.state for r in res.silver.collect()} == {"", None, "~"}


# ---- missing values ------------------------------------------------------

def test_missing_costs_against_brute_force(spark):
    cells = list(itertools.product([1, None], ["x", "", None], [1.0, float("nan"), None])) * 2
    df = spark.createDataFrame(cells, "a int, b string, `c.d` double")

    def lacks(row):
        return {i for i, v in enumerate(row) if v is None or v != v}

    got = {r.column: r for r in missing_costs(df).collect()}
    for i, c in enumerate(df.columns):
        assert got[c].n_missing == sum(i in lacks(r) for r in cells)
        assert got[c].n_alone == sum(lacks(r) == {i} for r in cells)
        assert got[c].n_lost == sum(bool(lacks(r)) for r in cells) and got[c].n_rows == len(cells)
    assert got["a"].n_rows - got["a"].n_lost == drop_incomplete(df).count()
    assert missing_masks(df).count() <= 8


def test_missing_costs_of_many_columns_and_no_rows(spark):
    wide = spark.range(5).select(*[F.when(F.col("id") != i, F.lit(1)).alias(f"c{i}") for i in range(130)])
    got = {r.column: r.n_alone for r in missing_costs(wide).collect()}
    assert got == {f"c{i}": int(i < 5) for i in range(130)}
    none = missing_costs(wide.limit(0)).collect()
    assert len(none) == 130 and all((r.n_missing, r.n_lost, r.n_rows) == (0, 0, 0) for r in none)
    assert [r.column for r in emptying_columns(wide).collect()] == ["c0", "c1", "c2", "c3", "c4"]


# ---- layout --------------------------------------------------------------

def test_file_counts_equal_duckdb(spark, tmp_path):
    path = str(tmp_path / "silver")
    df = spark.range(3000).withColumn("k", F.when(F.col("id") % 3 == 0, "hot/x").otherwise("cold"))
    df.repartition(3).write.partitionBy("k").parquet(path)
    got = {unquote(r.file).removeprefix("file:"): r.rows for r in file_layout(spark.read.parquet(path)).collect()}
    want = duckdb.sql(f"select filename f, count(*) n from read_parquet('{path}/*/*.parquet', "
                      "filename=true) group by 1").fetchall()
    assert got == dict(want) and sum(got.values()) == 3000
    by = duckdb.sql(f"select parse_path(filename)[-2] d, count(*) n, count(distinct filename) f "
                    f"from read_parquet('{path}/*/*.parquet', filename=true) group by 1").fetchall()
    folders = {r.folder: (r.rows, r.files) for r in folder_layout(spark.read.parquet(path)).collect()}
    assert sorted(folders.values()) == sorted((n, f) for _, n, f in by) and "k=hot%2Fx" in folders
    one = layout_summary(spark.read.parquet(path)).collect()[0]
    assert one.files == 6 and one.rows == 3000 and one.most_to_median >= 1
    assert block_layout(spark.read.parquet(path)).agg(F.sum("rows")).collect()[0][0] == 3000


# ---- drift ---------------------------------------------------------------

def records(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "record string")


def test_profile_counts_paths_and_kinds(spark):
    texts = ['{"a": 1, "b": {"c": null, "d": [1]}}', '{"a": 2.5, "b": {"c": "x"}}', '{"a": "t"}', "[1]", "nope", None]
    got = {(r.path, r.kind): (r.rows, r.records) for r in profile(records(spark, texts)).collect()}
    assert got == {("a", "long"): (1, 6), ("a", "decimal"): (1, 6), ("a", "string"): (1, 6), ("b", "object"): (2, 6),
                   ("b.c", "null"): (1, 6), ("b.c", "string"): (1, 6), ("b.d", "array"): (1, 6)}


def test_profiles_add_up(spark):
    a, b = ['{"x": 1}', '{"x": 2, "y": true}'], ['{"x": 1.5}', '{"y": false}']
    both = merged(profile(records(spark, a)), profile(records(spark, b)))
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, profile(records(spark, a + b)).collect()))
    assert {r.path: (r.kind, r.rows, r.missing) for r in fields(both).collect()} == {
        "x": ("decimal", 3, 0.25), "y": ("boolean", 2, 0.5)}


@pytest.mark.parametrize("kinds,want", [
    (["null"], "null"), (["null", "long"], "long"), (["long", "decimal"], "decimal"), (["double", "long"], "double"),
    (["string", "long"], "conflict"), (["boolean", "long"], "conflict"), (["array", "object"], "conflict"), ([], "null")])
def test_lattice(spark, kinds, want):
    kinds_ = F.array(*[F.lit(k) for k in kinds]).cast("array<string>")
    assert spark.range(1).select(join_kinds(kinds_).alias("k")).collect()[0].k == want


def test_drift_names_every_change(spark, tmp_path):
    old = profile(records(spark, ['{"same": 1, "wide": 1, "narrow": 1.5, "gone": "x", "clash": 1, "void": null}']))
    new = profile(records(spark, ['{"same": 2, "wide": 1.5, "narrow": 2, "came": {"k": 1}, "clash": "s", "void": 1}']))
    got = {r.path: r.change for r in drift(old, new).collect()}
    assert got == {"wide": "widened", "narrow": "narrowed", "gone": "dropped", "came": "added", "came.k": "added",
                   "clash": "conflict", "void": "widened"}
    history = SchemaHistory(spark, str(tmp_path))
    assert history.check(old) == []                          # a first run has nothing to compare with
    history.accept(old, "r1")
    assert history.check(old) == []
    with pytest.raises(DriftError, match="clash"):
        history.check(new)
    assert {r["path"] for r in history.check(new, ())} == set(got)


# ---- the once-only log ---------------------------------------------------

def test_once_log(spark, tmp_path):
    df = spark.range(3).withColumnRenamed("id", "v")
    log = OnceLog(spark, str(tmp_path / "log"))
    assert log.read(df.schema).collect() == []
    assert log.append(df, "one") and not log.append(df, "one")
    log.write(df, "two")                                     # cut short between write and commit
    assert log.read(df.schema).count() == 3 and log.batches() == ["one"]
    assert log.append(df, "two")
    got = log.read(df.schema).groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.count("timestamp").alias("t"))
    assert {(r.batch, r.n, r.t) for r in got.collect()} == {("one", 3, 3), ("two", 3, 3)}
    with pytest.raises(ValueError):
        log.append(df, "a/b")


# ---- store, guard --------------------------------------------------------

def test_store_objects(spark, tmp_path):
    store = Store(spark)
    at = str(tmp_path / "x")
    assert store.read_text(at) is None and store.names(at) == []
    store.replace(at, "one")
    store.replace(at, "zwei é")
    assert store.read_text(at) == "zwei é"
    assert [n for n in os.listdir(tmp_path) if n.endswith(".new")] == []
    with pytest.raises(Exception, match="already exists"):
        store.create(at, "again")


def test_guard_compares_roots(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "ab")
    spark.range(4).withColumn("k", F.col("id") % 2).write.partitionBy("k").parquet(a)
    spark.range(4).write.parquet(b)
    df = spark.read.parquet(a).join(spark.read.parquet(b), "id")
    assert [r.rsplit("/", 1)[1] for r in scan_roots(df)] == ["a", "ab"]
    for bad in (a, a + "/", f"{a}/k=0", str(tmp_path)):
        with pytest.raises(ValueError, match="refusing"):
            write_table(df, bad, mode="overwrite")
    write_table(df, str(tmp_path / "abc"), mode="overwrite")


def test_single_object_needs_one_part(spark, tmp_path, monkeypatch):
    from strata.sinks import files

    monkeypatch.setattr(files, "name_single_part", lambda *a: None)
    with pytest.raises(OSError, match="one part file"):
        publish_single_object(spark.range(3), str(tmp_path / "o"), object_name="x.json")


# ---- nearest vectors -----------------------------------------------------

def test_top_k_against_brute_force(spark):
    r = np.random.default_rng(3)
    m = np.round(r.normal(size=(70, 5)), 1)
    m[10] = m[11] = m[12] = m[40]                            # ties
    m[20] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(m)] + [(100, None), (101, [1.0, 2.0]), (None, [1.0] * 5), (102, [None] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(7)
    unit = m.astype(np.float32).astype(np.float64)
    size = np.sqrt((unit * unit).sum(1, keepdims=True))
    unit = unit / np.where(size > 0, size, 1)
    score = np.round(unit @ unit.T, 9)
    for block in (2048, 8):
        got = {}
        for x in top_k(df, df, 4, block_rows=block).collect():
            got.setdefault(x.query, []).append((x.rank, x.id))
        for i in range(70):
            order = sorted((j for j in range(70) if j != i), key=lambda j: (-score[i, j], j))[:4]
            assert sorted(got[i]) == [(k + 1, j) for k, j in enumerate(order)]
        assert set(got) == set(range(70))                   # 101 has no vector of its length beside itself
    own = top_k(df, df.filter("vec_id = 101"), 2, with_self=True).collect()
    assert [(x.query, x.rank, x.id) for x in own] == [(101, 1, 101)]
    assert top_k(df, df.limit(0), 3).collect() == [] and top_k(df.limit(0), df, 3).collect() == []


def brute_top_k(ids, m, k):
    size = np.sqrt((m * m).sum(1, keepdims=True))
    unit = m / np.where(size > 0, size, 1)
    score = np.round(unit @ unit.T, 9) + 0.0
    score[~np.isfinite(score)] = -np.inf
    out = {}
    for i, q in enumerate(ids):
        order = sorted((j for j in range(len(ids)) if ids[j] != q and score[i, j] > -np.inf), key=lambda j: (-score[i, j], ids[j]))
        out[q] = [(r + 1, ids[j]) for r, j in enumerate(order[:k])]
    return {q: v for q, v in out.items() if v}


def test_top_k_of_many_copies_and_odd_numbers(spark):
    r = np.random.default_rng(8)
    m = r.normal(size=(400, 6))
    m[50:250] = m[50]                                        # a large group of copies
    m[300:310] = 0
    m[320, 2] = np.inf                                       # no similarity to anything
    ids = r.permutation(400) * 3
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, m)],
                               "vec_id long, embedding array<double>").repartition(5)
    with np.errstate(all="ignore"):
        want = brute_top_k(ids.tolist(), m, 5)
    for block in (2048, 16):
        got = {}
        for x in top_k(df, df, 5, block_rows=block).collect():
            got.setdefault(x.query, []).append((x.rank, x.id))
        assert {q: sorted(v) for q, v in got.items()} == want


def test_top_k_sends_vectors_once_per_group_of_queries(spark, monkeypatch):
    """What is sent grows with groups, not with query blocks, and small Arrow batches don't make small blocks."""
    from strata.operators import vector_topk

    r = np.random.default_rng(5)
    m = r.normal(size=(640, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>").coalesce(1)
    sent, packed = [], vector_topk.packed
    monkeypatch.setattr(vector_topk, "packed", lambda *a: sent.append(packed(*a)) or sent[-1])
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        got = top_k(df, df, 2, block_rows=16)
        assert [x.count() for x in sent] == [40, 40]
        seen = spark.sparkContext.accumulator(0)
        best = vector_topk._best

        def counted(k, with_self):
            run = best(k, with_self)

            def count(queries, blocks):
                seen.add(blocks.num_rows)
                return run(queries, blocks)
            return count
        monkeypatch.setattr(vector_topk, "_best", counted)
        rows = {}
        for x in top_k(df, df, 2, block_rows=16).collect():
            rows.setdefault(x.query, []).append((x.rank, x.id))
        assert seen.value == 40 * 8                          # once per group; once per query block is 40 * 40
        assert {q: sorted(v) for q, v in rows.items()} == brute_top_k(list(range(640)), m, 2)
        assert got.count() == 640 * 2
    finally:
        spark.conf.set(key, before)
