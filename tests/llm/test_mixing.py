"""Entropy balancing against a plain water level, a scalar dual solver and the contract's bounds."""

import math
import re
from collections import Counter, defaultdict

import pytest

from strata.llm.mixing import mix, sizes, source_targets, tilts

SCHEMA = "doc_id long, text string, source string, size int, src string, target string, pos int, n int, copies int"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, s, 1, "x", "y", 2, 3, 4) for d, t, s in rows], SCHEMA)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(rows):
    total = Counter()
    for _, t, s in rows:
        total[s] += words(t)
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(total.values()), set(order), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * total[s]]
        if not over:
            return total, {**out, **share}
        for s in over:
            out[s] = 2 * total[s]
            left -= out[s]
            open_.remove(s)


def check(rows, got, near=0.01):
    total, target = plain_targets(rows)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, words(t)) for d, t, _ in rows)
    src = defaultdict(set)
    for d, _, s in rows:
        src[d].add(s)
    taken, most = Counter(), Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        (s,) = src[r.doc_id]
        assert r.source_size == total[s] and r.target == pytest.approx(target[s], rel=1e-9)
        taken[s] += r.taken
        most[s] = max(most[s], r.size)
    for s in total:
        assert abs(taken[s] - target[s]) <= max(near * target[s], 1)
    return taken


def test_mix(spark):
    rows = [(i, "w " * (i * 7919 % 90), ["a", "b", None, "é", "Z", ""][i * i % 6]) for i in range(400)]
    rows += [(1000 + i, "hot " * 5, "hot") for i in range(300)] + [(2000, None, "a"), (2001, " \t\n", "b")]
    got = mix(frame(spark, rows)).collect()
    check(rows, got)
    again = mix(frame(spark, rows[::-1]).repartition(5)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_sources_that_stop_at_twice_their_size(spark):
    rows = [(i, "x y", "a") for i in range(10)] + [(100 + i, "x " * 50, "b") for i in range(100)]
    rows += [(300 + i, "x " * 20, "c") for i in range(30)]
    taken = check(rows, mix(frame(spark, rows)).collect())
    assert taken["a"] == 40                       # capped: every document twice


def test_rates_solve_the_dual(spark):
    docs = frame(spark, [(i, "w " * (1 + i % 37), "ab"[i % 5 == 0]) for i in range(500)])
    cells = sizes(docs).groupBy("src", "size").count().withColumnRenamed("count", "docs")
    rows = cells.collect()
    for r in tilts(cells, source_targets(cells, (3, 1, 2), 1.5)).collect():
        own = [(c.size, c.docs) for c in rows if c.src == r.src]

        def value(t):
            return sum(n * s * 2 / (1 + math.exp(-t * s / r.scale)) for s, n in own)
        low, high = -60.0, 60.0
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if value(mid) < r.target else (low, mid)
        assert value(r.tilt) == pytest.approx(r.target, abs=0.3) and r.tilt == pytest.approx(low, abs=1e-2)


def test_odd_tables(spark):
    assert mix(frame(spark, [])).collect() == []
    blank = mix(frame(spark, [(1, None, None), (2, "", "a")])).collect()
    assert {(r.doc_id, r.size, r.source_size, r.target, r.taken) for r in blank} == {(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)}
    rows = [(None, "a b c", "s"), (7, "a b c", "s"), (7, "a b c", "s"), (8, "long " * 200_000, "t"), (9, "x y", None)]
    got = mix(frame(spark, rows)).collect()
    assert len(got) == 5 and all(r.taken <= 2 * r.size for r in got)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    check(rows, mix(docs).collect(), near=0.05)
