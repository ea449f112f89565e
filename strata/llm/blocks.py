"""Blocks: documents packed into bounded rows, and rounds of questions on them.

``write_blocks`` stores the documents as about one-MiB rows (``block``, ids,
lengths, zstd bytes) in the shared scratch folder, so that later stages read a
stable block again.  In a round every block sends each of its distinct keys
once per hash bucket; a bucket sees all blocks' keys and answers with bits in
the order they came in.  A very frequent key is thus at most one entry per
block, and no list of the documents that hold it is ever made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.textops import NULL_ID, column_bytes, column_ids, ids_out
from strata.session import scratch_path

BLOCK_BYTES = 1 << 20
ROW_BYTES = 16                              # what a document counts besides its text: id and size
BLOCK_SCHEMA = "block long, ids binary, sizes binary, data binary"
REPLY_SCHEMA = "block long, bucket int, kind int, bits binary"


def limit_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Arrow batches of at most ``rows`` rows (whole texts can be long)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame) -> DataFrame:
    """The two columns that operators read, free of clashing extra columns."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def cuts(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to at most ``most`` (or one item)."""
    out, begin, total = [], 0, 0
    for i, s in enumerate(sizes.tolist()):
        if total and total + s > most:
            out.append((begin, i))
            begin, total = i, 0
        total += s
    if begin < len(sizes):
        out.append((begin, len(sizes)))
    return out


def pack_block(block: int, ids: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> tuple:
    z = zstandard.ZstdCompressor(level=1)
    return block, z.compress(ids.tobytes()), z.compress(sizes.astype(np.int64).tobytes()), z.compress(data.tobytes())


class Block:
    """Documents of one block row: ``ids``, byte ``offs`` and ``data``."""

    def __init__(self, ids: bytes, sizes: bytes, data: bytes):
        z = zstandard.ZstdDecompressor()
        self.ids = np.frombuffer(z.decompress(ids), np.int64)
        self.offs = np.concatenate([[0], np.cumsum(np.frombuffer(z.decompress(sizes), np.int64))])
        self.data = np.frombuffer(z.decompress(data), np.uint8)

    def out_ids(self) -> pa.Array:
        return ids_out(self.ids)


def block_of(row: pa.RecordBatch | pa.Table, i: int = 0) -> Block:
    return Block(*(row.column(c)[i].as_py() for c in ("ids", "sizes", "data")))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks are filled across batches: their number follows the bytes, not the batch limit."""
    number = TaskContext.get().partitionId() << 33
    ids, sizes, data = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)

    def packed(parts):
        nonlocal number
        rows = []
        for lo, hi in parts:
            rows.append(pack_block(number, ids[lo:hi], data[offs[lo]:offs[hi]], sizes[lo:hi]))
            number += 1
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
            ["block", "ids", "sizes", "data"])

    for b in batches:
        more, offs = column_bytes(b.column("text"))
        ids, sizes = np.concatenate([ids, column_ids(b.column("doc_id"))]), np.concatenate([sizes, np.diff(offs)])
        data = np.concatenate([data, more])
        offs = np.concatenate([[0], np.cumsum(sizes)])
        parts = cuts(sizes + ROW_BYTES, BLOCK_BYTES)
        if len(parts) > 1:
            yield packed(parts[:-1])
            lo = parts[-1][0]
            ids, sizes, data = ids[lo:], sizes[lo:], data[offs[lo]:]
    if len(ids):
        offs = np.concatenate([[0], np.cumsum(sizes)])
        yield packed([(0, len(ids))])


def write_blocks(docs: DataFrame, name: str) -> DataFrame:
    limit_batches(docs.sparkSession)
    return stored(texts(docs).mapInArrow(_pack, BLOCK_SCHEMA), name)


def buckets(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def each_block(blocks: DataFrame, f: Callable[[int, Block], pa.Table | None], schema: str) -> DataFrame:
    """f(block id, Block) for every block row."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                t = f(b.column("block")[i].as_py(), block_of(b, i))
                if t is not None:
                    yield from t.to_batches()
    limit_batches(blocks.sparkSession, 64)
    return blocks.mapInArrow(run, schema)


def with_replies(blocks: DataFrame, replies: DataFrame,
                 f: Callable[[int, Block, pa.Table], pa.Table], schema: str) -> DataFrame:
    """f(block id, Block, its replies) for every block; no replies give an empty table."""
    def run(left, right):
        out = [f(left.column("block")[i].as_py(), block_of(left, i), right) for i in range(left.num_rows)]
        return pa.concat_tables(out) if out else EMPTY
    EMPTY = _empty(schema)
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)


def _empty(schema: str) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema)).empty_table()


class Keyed:
    """Distinct keys of a block, ordered by (bucket, value); ``inverse`` maps entries to them."""

    def __init__(self, key: np.ndarray, n_buckets: int):
        self.key, self.inverse = np.unique(key, return_inverse=True)
        bucket = (self.key % np.uint64(n_buckets)).astype(np.int32)
        order = np.argsort(bucket.astype(np.uint16) if n_buckets <= 1 << 16 else bucket, kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.key, self.bucket, self.inverse = self.key[order], bucket[order], back[self.inverse]
        self.edges = np.searchsorted(self.bucket, np.arange(n_buckets + 1))

    def least(self, values: np.ndarray) -> np.ndarray:
        """Smallest value of the entries of every distinct key."""
        out = np.full(len(self.key), np.iinfo(np.int64).max)
        np.minimum.at(out, self.inverse, values)
        return out

    def most(self, values: np.ndarray) -> np.ndarray:
        out = np.full(len(self.key), np.iinfo(np.int64).min)
        np.maximum.at(out, self.inverse, values)
        return out

    def slices(self):
        edges = self.edges.tolist()
        for b, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
            if hi > lo:
                yield b, slice(lo, hi)

    def answers(self, replies: pa.Table, kind: int, sizes: np.ndarray | None = None) -> np.ndarray:
        """Reply bits of ``kind`` in the order of the keys (``sizes`` bits per key)."""
        at = np.arange(len(self.key) + 1) if sizes is None else np.concatenate([[0], np.cumsum(sizes)])
        out = np.zeros(int(at[-1]), bool)
        edges = at[self.edges].tolist()
        mine = replies.filter(pc.equal(replies.column("kind"), kind))
        for b, bits in zip(mine.column("bucket").to_pylist(), mine.column("bits").to_pylist()):
            lo, hi = edges[b], edges[b + 1]
            out[lo:hi] = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo)
        return out


def joined(col: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Binary cells of packed numbers as one array, and the count of each cell."""
    parts = [np.frombuffer(x, dtype) for x in col.to_pylist()]
    return (np.concatenate(parts) if parts else np.zeros(0, dtype)), np.array([len(x) for x in parts], np.int64)


def bit_rows(table: pa.Table, sizes: np.ndarray, bits: np.ndarray, kind: int) -> pa.Table:
    """One reply row per input row whose slice of ``bits`` has a set bit."""
    ends = np.cumsum(sizes)
    count = np.concatenate([[0], np.cumsum(bits)])
    set_ = np.flatnonzero(count[ends] > count[ends - sizes])
    number, bucket = (table.column(c).take(pa.array(set_)).to_pylist() for c in ("block", "bucket"))
    rows = [(x, b, kind, np.packbits(bits[lo:hi]).tobytes())
            for x, b, lo, hi in zip(number, bucket, (ends - sizes)[set_].tolist(), ends[set_].tolist())]
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                    ["block", "bucket", "kind", "bits"])


SHARED_SCHEMA = "bucket int, block long, vals binary, multi binary"


def ask_shared(block: int, keyed: Keyed, ids: np.ndarray) -> pa.Table | None:
    """Rows of the first round: distinct 32-bit keys and whether two ids of the block hold them."""
    if not len(keyed.key):
        return None
    multi = keyed.least(ids) != keyed.most(ids)
    vals = (keyed.key >> np.uint64(32)).astype(np.uint32)
    rows = [(b, block, vals[s].tobytes(), np.packbits(multi[s]).tobytes()) for b, s in keyed.slices()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                    ["bucket", "block", "vals", "multi"])


def answer_shared(kind: int) -> Callable[[pa.Table], pa.Table]:
    """Bits: the key is held by two blocks, or by two ids of one block."""
    def run(t: pa.Table) -> pa.Table:
        vals, sizes = joined(t.column("vals"), np.uint32)
        multi = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n)
                                for x, n in zip(t.column("multi").to_pylist(), sizes.tolist())])
        order = np.argsort(vals)
        v = vals[order]
        first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        count = np.diff(np.append(first, len(v)))
        hit = (count > 1) | (np.maximum.reduceat(multi[order], first) > 0)
        bits = np.zeros(len(vals), bool)
        bits[order] = np.repeat(hit, count)
        return bit_rows(t, sizes, bits, kind)
    return run


