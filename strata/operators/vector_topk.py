"""2.10 X1: exact nearest vectors by blocked products.

Vectors and queries are packed into blocks of bounded size, one row per block, and
the blocks are dealt into groups of at most ``BLOCKS_PER_GROUP``.  A task gets one
group of queries and one of vectors, so a vector is sent once per group of queries
and a query once per group of vectors.  It multiplies the matrices block by block
and keeps the best ``k`` per query in a matrix of its own: (queries of the group) x k
whatever the table's size, and no (query, vector) pair is ever a row.  A product's
entries are compared with the query's worst kept score; only the few that can enter
the list are rounded and ranked.  The tasks' lists are mergeable: a ranked window per
query, cut to ``k`` rows on the map side first, gives the result.

All pairs are multiplied, so the time grows with vectors times queries; the data
sent grows with vectors times groups of queries and a task's memory does not grow.

Similarities are rounded to ``DIGITS`` digits before they are ranked and ties go to
the smaller id, so the order does not depend on how sums were grouped.  Null ids,
null vectors and vectors of another length than the query's take no part; a
query's own id is left out unless ``with_self``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.plans.lineage import cut_lineage

BLOCK_ROWS = 2048
BLOCKS_PER_GROUP = 32
ROWS_AT_ONCE = 512               # queries multiplied at a time
LEAST_GROUPS = 8                 # a small table is still dealt to many tasks
DIGITS = 9
PACKED = "block long, dim int, ids binary, vectors binary"
BEST = "query long, id long, score double"
_NO_ID = np.iinfo(np.int64).max


def _pack(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}       # by length, fewer than ``rows`` vectors

        def block(dim: int, ids: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
            size = np.sqrt((m * m).sum(axis=1, keepdims=True))
            unit = m / np.where(size > 0, size, 1)                      # a zero vector stays zero
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([dim], pa.int32()), pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
                 pa.array([unit.tobytes()], pa.binary())], ["block", "dim", "ids", "vectors"])

        for b in batches:
            ids = b.column("id").to_numpy(zero_copy_only=False)
            dims = pc.list_value_length(b.column("vector")).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                flat = b.column("vector").take(pa.array(at)).flatten().cast(pa.float64())
                m = flat.to_numpy(zero_copy_only=False).reshape(len(at), int(dim))
                parts = held.pop(dim, []) + [(ids[at], m)]
                if sum(len(i) for i, _ in parts) < rows:
                    held[dim] = parts
                    continue
                own, m = map(np.concatenate, zip(*parts))
                whole = len(own) - len(own) % rows
                for lo in range(0, whole, rows):
                    yield block(int(dim), own[lo:lo + rows], m[lo:lo + rows])
                    number += 1
                if whole < len(own):
                    held[dim] = [(own[whole:], m[whole:])]
        for dim, parts in held.items():
            yield block(int(dim), *map(np.concatenate, zip(*parts)))
            number += 1
    return run


def packed(df: DataFrame, id_col: str, vector_col: str, name: str, rows: int = BLOCK_ROWS) -> DataFrame:
    """Unit vectors of ``df`` in stored blocks of at most ``rows`` of one length."""
    one = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    whole = one.filter(F.col("id").isNotNull() & F.col("vector").isNotNull()
                       & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x)))
    return cut_lineage(whole.mapInArrow(_pack(rows), PACKED), name)


def _matrix(table: pa.Table, i: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(table.column("ids")[i].as_py(), np.int64)
    return ids, np.frombuffer(table.column("vectors")[i].as_py(), np.float64).reshape(len(ids), -1)


def _merged(top: np.ndarray, ids: np.ndarray, row: np.ndarray, id_: np.ndarray, score: np.ndarray) -> None:
    """Entries (row, id, score) merged into the best lists of their rows."""
    touched, at = np.unique(row, return_inverse=True)
    k = top.shape[1]
    place = np.concatenate([np.repeat(np.arange(len(touched)), k), at])
    score = np.concatenate([top[touched].ravel(), score])
    id_ = np.concatenate([ids[touched].ravel(), id_])
    order = np.lexsort((id_, -score, place))
    place = place[order]
    rank = np.arange(len(place)) - np.searchsorted(place, np.arange(len(touched)))[place]
    order = order[rank < k]                                  # every list has k places, so k are left of each
    top[touched], ids[touched] = score[order].reshape(-1, k), id_[order].reshape(-1, k)


def _entries(raw: np.ndarray, own: np.ndarray, top: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, id, score) of the products that can enter the best lists, scores rounded."""
    k = top.shape[1]
    worst = top[:, -1]
    if raw.shape[1] > k and np.isneginf(worst).any():        # a first block: its own k-th best bounds what can enter
        worst = np.maximum(worst, np.partition(raw, raw.shape[1] - k, axis=1)[:, -k])
    slack = 2 * 10.0 ** -DIGITS                              # scores further apart than a digit are not rounded to one
    row, col = np.nonzero((raw >= (worst - slack)[:, None]) & (raw > -np.inf))
    score, id_ = np.round(raw[row, col], DIGITS) + 0.0, own[col]
    last, name = top[row, -1], ids[row, -1]
    enters = (score > last) | ((score == last) & (id_ < name))
    return row[enters], id_[enters], score[enters]


def _products(names: np.ndarray, wanted: np.ndarray, own: np.ndarray, m: np.ndarray, with_self: bool) -> np.ndarray:
    """Unrounded similarities; minus infinity for no number, and for a query's own id."""
    raw = wanted @ m.T
    if np.isnan(m).any() or np.isnan(wanted).any():
        raw[np.isnan(raw)] = -np.inf
    if not with_self:
        here = np.flatnonzero(np.isin(own, names))
        if len(here):
            r, c = np.nonzero(names[:, None] == own[here][None, :])
            raw[r, here[c]] = -np.inf
    return raw


def _best(k: int, with_self: bool):
    def run(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        out: list[tuple] = []
        own_blocks = sorted((_matrix(blocks, j) for j in range(blocks.num_rows)), key=lambda b: b[0].min())
        for i in range(queries.num_rows):
            names, wanted = _matrix(queries, i)
            top = np.full((len(names), k), -np.inf)
            ids = np.full((len(names), k), _NO_ID)
            for own, m in own_blocks:
                if m.shape[1] != wanted.shape[1]:
                    continue
                for lo in range(0, len(names), ROWS_AT_ONCE):
                    part = slice(lo, lo + ROWS_AT_ONCE)
                    raw = _products(names[part], wanted[part], own, m, with_self)
                    row, id_, score = _entries(raw, own, top[part], ids[part])
                    if len(row):
                        _merged(top[part], ids[part], row, id_, score)
            q, at = np.nonzero(top > -np.inf)
            out.append((names[q], ids[q, at], top[q, at]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())],
                        ["query", "id", "score"])
    return run


def _groups(n_blocks: int) -> int:
    return max(min(n_blocks, LEAST_GROUPS), -(-n_blocks // BLOCKS_PER_GROUP), 1)


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
          with_self: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query``, ``rank`` (1 to k), ``id`` and ``score`` (cosine similarity) of the ``k`` likest vectors of each query.

    The vectors are sent once per group of query blocks, the queries once per group
    of vector blocks; the driver holds two counts only.
    """
    spark = vectors.sparkSession
    stored = packed(vectors, id_col, vector_col, "vector-blocks", block_rows)
    asked = packed(queries, id_col, vector_col, "query-blocks", block_rows)
    n_asked, n_stored = asked.count(), stored.count()
    if not n_asked:
        return spark.createDataFrame([], "query long, rank int, id long, score double")

    def dealt(blocks: DataFrame, own: str, groups: int, other: str, others: int) -> DataFrame:
        """Blocks with the number of their group, once for each group of the other side."""
        return (blocks.select(F.pmod(F.xxhash64("block"), F.lit(groups)).alias(own), "ids", "vectors")
                .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long")))))

    asking, holding = _groups(n_asked), _groups(n_stored)
    left = dealt(asked, "asking", asking, "holding", holding)
    right = dealt(stored, "holding", holding, "asking", asking)
    best = (left.groupBy("asking", "holding").cogroup(right.groupBy("asking", "holding"))
            .applyInArrow(_best(k, with_self), BEST))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query", "rank", "id", "score"))
