"""MinHash near-dedup with an LSH forest.

Each distinct shingle set has a signature of ``TREES`` times ``DEPTH`` minhash
values.  A tree is the sorted order of one group of values; sets that share its
first ``SHALLOW`` values lie next to each other, and the further values put the
likest ones side by side.  Candidates are all sets of a run with one prefix of
``SHALLOW`` values, however long it is.  Two rounds keep the number of
comparisons near the number of sets however large a group of copies is:

1. every set is compared with its next neighbour in every order, and the links
   that hold form components;
2. a run whose sets are in different components gets their full sets, and all
   sets outside its largest component are compared with the rest; large runs
   are dealt to groups of bounded size.  Only links are written, one for each
   set and component that it meets.  A run of many components costs the square
   of the number of sets outside its largest one.

A comparison is exact, on the full shingle sets.  Equal sets are one node from
the start.  A pair at the threshold 0.8 shares the first four values of at
least one of 16 trees with probability 0.9998.

Defined cases: null or empty text has an empty set and links with nothing;
fewer words than a shingle make one shingle; rows with one doc_id are one node
and each gives a row (linked by what any of them holds); a null doc_id is the
smallest id; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.blocks import column_ids, cuts, limit_batches, stored, texts
from strata.llm.components import components
from strata.llm.textops import NULL_ID, SPACES, Rolling, Words, column_bytes, group_starts, table

TREES, DEPTH, SHALLOW, BLOCK = 16, 8, 4, 512
PIECE = 1 << 20
_TABLE = table(SPACES, lower=True)
_RNG = np.random.Generator(np.random.PCG64(11))
_MULTIPLY = _RNG.integers(1, 1 << 62, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)
SKETCH = "id long, n_shingles long, digest binary, sig binary, body binary"


def shingle_sets(data: np.ndarray, offs: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, concatenated, and their edges."""
    w = Words(data, offs, *_TABLE)
    n = np.diff(w.first)
    many = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), many)
    begin = w.first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    stop = begin + np.minimum(n, words)[doc]
    h = Rolling(w.norm).of(w.start[begin], w.start[stop] - 1)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    one = group_starts(doc, h)
    return h[one], np.searchsorted(doc[one], np.arange(len(n) + 1))


def _signatures(h: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Low 16 bits of the minhash values of every set, [sets, values]; empty sets are all zero."""
    full = np.flatnonzero(np.diff(edges))
    out = np.zeros((len(edges) - 1, TREES * DEPTH), np.uint16)
    if len(full):
        x = h & np.uint64(0xFFFFFFFF)
        for i in range(TREES * DEPTH):
            v = ((x * _MULTIPLY[i] + _ADD[i]) >> np.uint64(32)).astype(np.uint32)
            out[full, i] = np.minimum.reduceat(v, edges[full]).astype(np.uint16)
    return out


def _sketch(words: int):
    def run(batches):
        z = zstandard.ZstdCompressor(level=1)
        for b in batches:
            data, offs = column_bytes(b.column("text"))
            ids = column_ids(b.column("doc_id"))
            for lo, hi in cuts(np.diff(offs), PIECE):
                part, at = data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
                h, edges = shingle_sets(part, at, words)
                sig = _signatures(h, edges)
                digest = [hashlib.md5(h[s:e].tobytes()).digest() for s, e in zip(edges[:-1], edges[1:])]
                body = [z.compress(part[s:e].tobytes()) for s, e in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo:hi]), pa.array(np.diff(edges)), pa.array(digest, pa.binary()),
                     pa.array([x.tobytes() for x in sig], pa.binary()), pa.array(body, pa.binary())],
                    ["id", "n_shingles", "digest", "sig", "body"])
    return run


def _sorted_runs(batches):
    """(key matrix, ids, components) of consecutive rows with one tree and shallow prefix."""
    keys, ids, comps, last = [], [], [], None

    def out():
        return (np.frombuffer(b"".join(keys), np.uint16).reshape(-1, DEPTH), np.array(ids, np.int64),
                np.array(comps, np.int64))

    for b in batches:
        for tree, key, i, c in zip(b.column("tree").to_pylist(), b.column("key").to_pylist(),
                                   b.column("id").to_pylist(), b.column("comp").to_pylist()):
            if (tree, key[:2 * SHALLOW]) != last:
                if len(ids) > 1:
                    yield out()
                keys, ids, comps, last = [], [], [], (tree, key[:2 * SHALLOW])
            keys.append(key)
            ids.append(i)
            comps.append(c)
    if len(ids) > 1:
        yield out()


def _pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _neighbours(batches):
    for _, ids, _ in _sorted_runs(batches):
        yield _pair_batch(ids[:-1], ids[1:])


def _mixed_runs(batches):
    """Members of the runs that hold several components, dealt to groups of bounded size.

    Every ``BLOCK`` sets outside the run's largest component give a group with
    each such block after them and with each block of the largest component, so
    that every pair of sets of different components meets in one.
    """
    number = TaskContext.get().partitionId() << 33
    for _, ids, comp in _sorted_runs(batches):
        labels, place, count = np.unique(comp, return_inverse=True, return_counts=True)
        if len(labels) == 1:
            continue
        common = place == count.argmax()
        others, most = ([x[i:i + BLOCK] for i in range(0, len(x), BLOCK)]
                        for x in (np.flatnonzero(~common), np.flatnonzero(common)))
        for i, part in enumerate(others):
            for more in others[i + 1:] + most:
                own = np.concatenate([part, more])
                if (comp[own] != comp[own[0]]).any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), number)), pa.array(ids[own]), pa.array(comp[own])],
                        ["leaf", "id", "comp"])
                    number += 1


def _bodies_sets(bodies: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle sets of compressed texts, concatenated, and their edges."""
    z, sets, sizes = zstandard.ZstdDecompressor(), [], []
    raw = [z.decompress(x) for x in bodies]
    for lo, hi in cuts(np.array([len(x) for x in raw]), PIECE):
        offs = np.concatenate([[0], np.cumsum([len(x) for x in raw[lo:hi]])])
        h, edges = shingle_sets(np.frombuffer(b"".join(raw[lo:hi]), np.uint8), offs, words)
        sets.append(h)
        sizes.append(np.diff(edges))
    return np.concatenate(sets), np.concatenate([[0], *[np.cumsum(np.concatenate(sizes))]])


def _link_group(words: int, percent: int):
    """Links of a group between different components: one for each set and component that it meets."""
    def run(t: pa.Table) -> pa.Table:
        ids, comp = (t.column(c).to_numpy() for c in ("id", "comp"))
        h, edges = _bodies_sets(t.column("body").to_pylist(), words)
        names, shingle = np.unique(h, return_inverse=True)
        size = np.diff(edges)
        mark = np.zeros(len(names) + 1, np.int32)
        labels, count = np.unique(comp, return_counts=True)
        a, b = [], []
        for i in np.flatnonzero(comp != labels[count.argmax()]):       # of two components one is not the largest
            mark[shingle[edges[i]:edges[i + 1]]] = 1
            both = np.add.reduceat(mark[shingle], edges[:-1])
            mark[shingle[edges[i]:edges[i + 1]]] = 0
            near = np.flatnonzero((100 * both >= percent * (size + size[i] - both)) & (comp != comp[i]))
            if len(near):
                near = near[np.unique(comp[near], return_index=True)[1]]
                a.append(np.full(len(near), ids[i]))
                b.append(ids[near])
        both = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b)]
        return pa.table([pa.array(np.minimum(*both)), pa.array(np.maximum(*both))], ["a", "b"])
    return run


def _orders(entries: DataFrame) -> DataFrame:
    """The trees' sorted orders; rows with one shallow prefix are in one partition."""
    return (entries.repartition("tree", F.substring("key", 1, 2 * SHALLOW))
            .sortWithinPartitions("tree", "key", "id"))


def _compare(pairs: DataFrame, bodies: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets are alike, by comparing the full sets."""
    def run(batches):
        for b in batches:
            n, keep = b.num_rows, np.zeros(b.num_rows, bool)
            if n:
                h, edges = _bodies_sets(b.column("left").to_pylist() + b.column("right").to_pylist(), words)
            for i in range(n):
                x, y = h[edges[i]:edges[i + 1]], h[edges[n + i]:edges[n + i + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = both > 0 and 100 * both >= percent * (len(x) + len(y) - both)
            yield b.select(["a", "b"]).filter(pa.array(keep))

    limit_batches(pairs.sparkSession, 64)
    full = (pairs.hint("merge").join(bodies.select(F.col("id").alias("a"), F.col("body").alias("left")), "a")
            .hint("merge").join(bodies.select(F.col("id").alias("b"), F.col("body").alias("right")), "b"))
    return full.select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Rows link when their sets of ``words``-word shingles have a Jaccard
    similarity of at least ``percent``/100; the smallest doc_id of a connected
    component names it and is kept.
    """
    spark = docs.sparkSession
    limit_batches(spark)
    rows = stored(texts(docs).mapInArrow(_sketch(words), SKETCH), "forest-sketches")
    some = rows.filter("n_shingles > 0")
    nodes = stored(some.groupBy("digest").agg(F.min("id").alias("id"), F.any_value("sig").alias("sig")),
                   "forest-nodes")
    entries = nodes.select("id", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda t: F.substring(F.col("sig"), t * 2 * DEPTH + 1, F.lit(2 * DEPTH)))).alias("tree", "key"))
    first = stored(_orders(entries.withColumn("comp", F.lit(0).cast("long")))
                   .mapInArrow(_neighbours, "a long, b long").distinct(), "forest-neighbours")
    active = first.select(F.col("a").alias("id")).union(first.select("b")).distinct()
    owners = stored(nodes.select("id", "digest").join(active, "id", "left_semi"), "forest-active")
    bodies = stored(some.select("id", "digest", "body").hint("merge").join(owners, ["id", "digest"], "left_semi")
                    .dropDuplicates(["id", "digest"]).select("id", "body"), "forest-bodies")
    links = stored(_compare(first, bodies, words, percent), "forest-links")
    parts = components(links)
    again = (entries.join(owners.select("id"), "id", "left_semi").join(parts, "id", "left")
             .select("id", "tree", "key", F.coalesce("component_id", "id").alias("comp")))
    mixed = stored(_orders(again).mapInArrow(_mixed_runs, "leaf long, id long, comp long"), "forest-leaves")
    more = stored(mixed.hint("merge").join(bodies, "id").groupBy("leaf")
                  .applyInArrow(_link_group(words, percent), "a long, b long"), "forest-links")
    if not more.isEmpty():
        parts = components(links.union(more))
    # equal sets share a node; a doc_id that repeats belongs to several
    node = some.select("id", "digest").distinct().join(nodes.select("digest", F.col("id").alias("node")), "digest")
    tied = node.filter("id <> node").select(F.col("id").alias("a"), F.col("node").alias("b"))
    repeated = some.groupBy("id").agg(F.count_distinct("digest").alias("k")).filter("k > 1")
    if not repeated.isEmpty():
        parts = components(links.union(more).union(tied))
    named = (node.groupBy("id").agg(F.min("node").alias("node"))
             .join(parts.withColumnRenamed("id", "node"), "node", "left")
             .select("id", F.coalesce("component_id", "node").alias("component_id")))
    own = F.coalesce("component_id", "id")

    def shown(c):
        return F.when(c != NULL_ID, c)

    return rows.select("id", "n_shingles").join(named, "id", "left").select(
        shown(F.col("id")).alias("doc_id"), "n_shingles", shown(own).alias("component_id"),
        (own == F.col("id")).alias("kept"))
