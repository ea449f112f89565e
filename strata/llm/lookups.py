"""Corpus-wide numbers of packed keys, without a row per key and document.

A block (a bounded run of documents) asks for the numbers of its distinct keys
with one row per bucket, keys packed in order; a group (bucket, salt) holds that
bucket's part of the table once and answers with packed numbers in the order of
the keys.  A key that every document holds is one entry per block.  Buckets
follow the size of the table and salts the number of entries asked for, so a
group's memory does not grow with either: ``TABLE_KEYS`` and ``ASKED_KEYS`` on
average, whatever the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLE_KEYS = 1 << 18
ASKED_KEYS = 1 << 21
SPREAD = 1_000_003               # prime: keys that follow a pattern still spread over buckets
ASK_SCHEMA = "bucket int, salt int, block long, keys binary"
REPLY_SCHEMA = "block long, bucket int, numbers binary"


class Shape:
    """Numbers of buckets and salts for a table of ``distinct`` keys asked ``asked`` times."""

    def __init__(self, distinct: int, asked: int):
        self.buckets = max(1, min(SPREAD, -(-distinct // TABLE_KEYS)))
        self.salts = max(1, -(-asked // (self.buckets * ASKED_KEYS)))

    def bucket(self, keys: np.ndarray) -> np.ndarray:
        return (keys % SPREAD % self.buckets).astype(np.int64)

    def bucket_column(self, key: str) -> Column:
        return (F.col(key) % SPREAD % self.buckets).cast("int")

    def order(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order of ``keys`` by bucket, edges of the buckets in it)."""
        bucket = self.bucket(keys)
        order = np.argsort(bucket, kind="stable")
        return order, np.searchsorted(bucket[order], np.arange(self.buckets + 1))


def ask(shape: Shape, block: int, keys: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
    """Rows of ASK_SCHEMA for a block's distinct non-negative keys."""
    order, edges = shape.order(keys)
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), block % shape.salts, block, keys[order[edges[b]:edges[b + 1]]].tobytes()


def ask_table(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.binary()))],
                    ["bucket", "salt", "block", "keys"])


def answers(shape: Shape, asks: DataFrame, table: DataFrame, values: list[str]) -> DataFrame:
    """Rows of REPLY_SCHEMA: for each asked row the ``values`` (long columns of
    ``table``, keyed by ``key``) of its keys, one array after the other; 0 where
    the table has no such key."""
    parts = table.select(shape.bucket_column("key").alias("bucket"), "key", *values).withColumn(
        "salt", F.explode(F.array([F.lit(s) for s in range(shape.salts)])
                          if shape.salts <= 64 else F.sequence(F.lit(0), F.lit(shape.salts - 1))))
    return (parts.groupBy("bucket", "salt").cogroup(asks.groupBy("bucket", "salt"))
            .applyInArrow(_answer(values), REPLY_SCHEMA))


def _answer(values: list[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(table: pa.Table, asks: pa.Table) -> pa.Table:
        keys = table.column("key").to_numpy()
        order = np.argsort(keys)
        keys = keys[order]
        held = [table.column(v).to_numpy()[order] for v in values]
        out = []
        for block, bucket, raw in zip(asks.column("block").to_pylist(), asks.column("bucket").to_pylist(),
                                      asks.column("keys")):
            asked = np.frombuffer(raw.as_py(), np.int64)
            numbers = np.zeros((len(values), len(asked)), np.int64)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
                hit = keys[at] == asked
                for i, h in enumerate(held):
                    numbers[i, hit] = h[at[hit]]
            out.append((block, bucket, numbers.tobytes()))
        cols = list(zip(*out)) if out else [[], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.binary()))],
                        ["block", "bucket", "numbers"])
    return run


def received(shape: Shape, keys: np.ndarray, replies: pa.Table, n_values: int) -> np.ndarray:
    """(n_values, len(keys)) numbers of a block's keys from its reply rows."""
    out = np.zeros((n_values, len(keys)), np.int64)
    order, edges = shape.order(keys)
    for bucket, raw in zip(replies.column("bucket").to_pylist(), replies.column("numbers")):
        at = order[edges[bucket]:edges[bucket + 1]]
        out[:, at] = np.frombuffer(raw.as_py(), np.int64).reshape(n_values, -1)
    return out
