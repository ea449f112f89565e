"""Merkle manifest against a plain recursive version."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.llm.merkle import DOCUMENT_FIELDS, Manifest, audit, fold, lowered, tree, with_siblings

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "pos int, grp string, hash int, n int, steps string")


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "g", 2, 3, "s") for r in rows], SCHEMA)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(d, text, lang, source, n):
    def cell(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"
    return sha(cell(d), cell(source), cell(lang), cell(n), cell(text))


def climb(hashes):
    """(root, per leaf the list of (left, right))."""
    steps, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        for i, p in enumerate(at):
            run = p // 16 * 16
            steps[i].append(("".join(level[run:p]), "".join(level[p + 1:run + 16])))
            at[i] = p // 16
        level = [sha(*level[i:i + 16]) for i in range(0, len(level), 16)]
    return level[0], steps


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(*r), r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([h for *_, h, _ in sorted(by[s], key=lambda x: x[:3])]) for s in sources}
    root, upper = climb([trees[s][0] for s in sources])
    for s, up in zip(sources, upper):
        for (_, _, h, r), way in zip(sorted(by[s], key=lambda x: x[:3]), trees[s][1]):
            d, text = r[0], r[1]
            folded = h
            if d is not None and zlib.crc32(str(d).encode()) % 5 == 0 and text is not None:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
                folded = leaf(d, low, *r[2:])
            for left, right in way + up:
                folded = sha(left, folded, right)
            yield (d, h, trees[s][0], root, sha(*(x + y for x, y in way + up)), folded, folded == root)


def run(spark, rows):
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = audit(frame(spark, rows), picked, lowered()).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return Counter(map(tuple, got.collect()))


def rows_of(n, seed=1):
    r = random.Random(seed)
    sources = [None, "", "a", "B", "é", "z" * 40]
    weights = [1, 1, 12, 3, 2, 1]
    return [(i, r.choice([None, "", "Plain", "lower only", "ÀÉ x", "Tab\there"]) if i % 4 else f"Text {i}",
             r.choice([None, "en"]), r.choices(sources, weights)[0], r.choice([None, 0, 12345])) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 16, 17, 700])
def test_manifest(spark, n):
    rows = rows_of(n)
    assert run(spark, rows) == Counter(plain(rows))


def test_one_source_and_lone_rows(spark):
    one = [(i, f"T{i}", "en", "s", i) for i in range(289)]
    assert run(spark, one) == Counter(plain(one))
    lone = [(i, "X", None, f"s{i}", None) for i in range(40)]
    assert run(spark, lone) == Counter(plain(lone))


def test_null_and_repeated_ids_and_a_long_text(spark):
    rows = [(None, "A", "en", "s", 1), (None, "B", "en", "s", 1), (3, "Aa", "en", "s", 1), (3, "Aa", "en", "s", 1),
            (3, "Ab", "en", "s", 1), (15, "Word " * 200_000, "en", None, 1_000_000)]
    assert run(spark, rows) == Counter(plain(rows))


def test_empty_table(spark):
    assert run(spark, []) == Counter()


def test_offsets_count_only_inside_the_run(spark):
    nodes = spark.createDataFrame([("g", i, 35, f"<{i}>") for i in range(35)], "grp string, pos long, n long, hash string")
    got = {r.pos: (r.left, r.right) for r in with_siblings(nodes).collect()}
    for p in range(35):
        run_ = p // 16 * 16
        assert got[p] == ("".join(f"<{i}>" for i in range(run_, p)),
                          "".join(f"<{i}>" for i in range(p + 1, min(run_ + 16, 35))))
    assert [lv.count() for lv in tree(nodes, "t")] == [35, 3, 1]


def test_a_changed_row_fails_alone(spark):
    rows = [(i, f"T{i}", "en", "s", i) for i in range(40)]
    claimed = F.when(F.col("doc_id") == 7, F.sha2(F.lit("other"), 256))
    got = Manifest(frame(spark, rows), DOCUMENT_FIELDS, "source", "doc_id", {"claimed": claimed}).proofs()
    bad = got.filter(fold(F.coalesce("claimed", "leaf"), F.col("steps")) != F.col("root")).collect()
    assert [r.key for r in bad] == [7]
