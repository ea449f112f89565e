"""Benchmark decontamination by a distributed positional inverted index.

``build_index`` stores, per shard of documents, one row per term with the
sorted positions of the term in the shard (delta varints), and one directory
row (null term) with the shard's documents.  A shard holds a bounded number of
text bytes, so no posting list grows with the corpus.

``phrase_matches`` takes phrases, fetches only the postings of their terms,
picks every phrase's rarest term over the corpus, and sends the phrase to the
shards that hold this term.  There the offset-adjusted lists are intersected
from the rarest list on.  With ``slop`` each other word may lie up to that many
places from its place in the phrase (proximity match).

Defined cases: null or empty texts have no words; rows with one doc_id are
reported each; an item without words has no phrase; a null item_id is the
empty string; repeated items count once; empty tables give no rows (documents)
or no hits (benchmark); extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.blocks import _empty, column_ids, cuts, ids_out, limit_batches, stored, texts
from strata.llm.textops import NON_WORD, Words, column_bytes, ramp, table

SHARD_BYTES = 6 << 20
#: Phrases that one task takes to one shard.
PHRASES_PER_TASK = 100_000
_TABLE = table(NON_WORD, lower=True)
INDEX = "shard long, term binary, n long, postings binary, ids array<long>, sizes array<long>"
MATCHES = "shard long, ord int, doc_id long, phrase_id long, start long, length int"


def varints(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, end offset of each number): seven bits a byte, low bits first."""
    size = np.ones(len(x), np.int64)
    for k in (7, 14, 21, 28):
        size += x >= (1 << k)
    end = np.cumsum(size)
    out = np.zeros(int(end[-1]) if len(x) else 0, np.uint8)
    for k in range(5):
        more = np.flatnonzero(size > k)
        out[(end - size)[more] + k] = ((x[more] >> (7 * k)) & 127) | ((size[more] > k + 1) * 128)
    return out, end


def numbers(data: bytes) -> np.ndarray:
    """Inverse of ``varints``."""
    b = np.frombuffer(data, np.uint8).astype(np.int64)
    if not len(b):
        return b
    first = np.concatenate([[0], np.flatnonzero(b < 128)[:-1] + 1])
    place = np.arange(len(b)) - np.repeat(first, np.diff(np.append(first, len(b))))
    return np.add.reduceat((b & 127) << (7 * place), first)


def _shard(number: int, ids: np.ndarray, data: np.ndarray, offs: np.ndarray) -> pa.RecordBatch:
    w = Words(data, offs, *_TABLE)
    names = ("shard", "term", "n", "postings", "ids", "sizes")
    code = w.values().dictionary_encode()
    terms = len(code.dictionary)
    key = (code.indices.to_numpy(zero_copy_only=False).astype(np.int64) << 32) | np.arange(w.n)
    key.sort()
    at, pos = key >> 32, key & 0xFFFFFFFF
    count = np.bincount(at, minlength=terms)
    first = np.cumsum(count) - count
    gap = np.diff(pos, prepend=0)
    gap[first] = pos[first]
    body, end = varints(gap)
    edge = np.concatenate([[0], end])[np.append(first, w.n)].astype(np.int32)
    postings = pa.Array.from_buffers(pa.binary(), terms, [None, pa.py_buffer(edge), pa.py_buffer(body)])
    lists = pa.list_(pa.int64())
    cols = [pa.array(np.full(terms + 1, number)),
            pa.concat_arrays([code.dictionary, pa.array([None], pa.binary())]),
            pa.array(np.append(count, w.n)),
            pa.concat_arrays([postings, pa.array([None], pa.binary())]),
            pa.concat_arrays([pa.nulls(terms, lists), _one_list(ids_out(ids))]),
            pa.concat_arrays([pa.nulls(terms, lists), _one_list(pa.array(np.diff(w.first)))])]
    return pa.RecordBatch.from_arrays(cols, list(names))


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _index_rows(batches):
    number = TaskContext.get().partitionId() << 33
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def flush():
        ids, data, sizes = (np.concatenate(x) for x in zip(*held))
        return _shard(number, ids, data, np.concatenate([[0], np.cumsum(sizes)]))

    for b in batches:
        data, offs = column_bytes(b.column("text"))
        ids, sizes = column_ids(b.column("doc_id")), np.diff(offs)
        for lo, hi in cuts(sizes, SHARD_BYTES):
            more = int(offs[hi] - offs[lo])
            if held and size + more > SHARD_BYTES:
                yield flush()
                held, size, number = [], 0, number + 1
            held.append((ids[lo:hi], data[offs[lo]:offs[hi]], sizes[lo:hi]))
            size += more
    if held:
        yield flush()


def build_index(docs: DataFrame) -> DataFrame:
    """Store the positional index of all words of all documents; returns the stored table."""
    limit_batches(docs.sparkSession)
    return stored(texts(docs).mapInArrow(_index_rows, INDEX), "phrase-index")


def item_phrases(items: DataFrame, window: int = 13) -> DataFrame:
    """item_id and phrase (words joined by a space): every window of the item's words,
    or all its words where they are fewer."""
    def run(batches):
        for b in batches:
            data, offs = column_bytes(b.column("text"))
            w = Words(data, offs, *_TABLE)
            n = np.diff(w.first)
            many = np.where(n > window, n - window + 1, np.minimum(n, 1))
            begin = ramp(w.first[:-1], many)
            stop = begin + np.repeat(np.minimum(n, window), many)
            text = w.norm.tobytes()
            out = [text[s:e - 1] for s, e in zip(w.start[begin].tolist(), w.start[stop].tolist())]
            owner = pa.array(np.repeat(np.arange(len(n)), many))
            yield pa.RecordBatch.from_arrays(
                [b.column("item_id").take(owner), pa.array(out, pa.binary())], ["item_id", "phrase"])
    limit_batches(items.sparkSession)
    item = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                        F.col("text").cast("string").alias("text"))
    return item.mapInArrow(run, "item_id string, phrase binary").distinct()


def _near(starts: np.ndarray, places: np.ndarray, slop: int) -> np.ndarray:
    """The starts that have a place within ``slop``."""
    at = np.searchsorted(places, starts - slop)
    return starts[(at < len(places)) & (places[np.minimum(at, len(places) - 1)] <= starts + slop)]


def _search(wanted: pa.Table, rows: pa.Table, slop: int, none: pa.Table) -> pa.Table:
    lists, first, ids, shard = {}, None, None, None
    for i in range(rows.num_rows):
        term = rows.column("term")[i].as_py()
        if term is None:
            first = np.concatenate([[0], np.cumsum(rows.column("sizes")[i].as_py())]).astype(np.int64)
            ids = rows.column("ids")[i].values
            shard = rows.column("shard")[i].as_py()
        else:
            lists[term] = rows.column("postings")[i].as_py()
    out = []
    for k, phrase in zip(wanted.column("phrase_id").to_pylist(), wanted.column("phrase").to_pylist()):
        words = phrase.split(b" ")
        if not all(w in lists for w in words):
            continue
        order = sorted(range(len(words)), key=lambda j: len(lists[words[j]]))
        starts = None
        for j in order:
            if isinstance(lists[words[j]], bytes):
                lists[words[j]] = np.cumsum(numbers(lists[words[j]]))
            places = lists[words[j]] - j
            starts = places if starts is None else _near(starts, places, slop)
            if not len(starts):
                break
        starts = starts[starts >= 0]
        doc = np.searchsorted(first, starts, side="right") - 1
        inside = starts + len(words) <= first[doc + 1]
        if inside.any():
            out.append((k, starts[inside], doc[inside], len(words)))
    if not out:
        return none
    n = [len(x[1]) for x in out]
    starts, doc = (np.concatenate([x[i] for x in out]) for i in (1, 2))
    return pa.table([pa.array(np.full(len(doc), shard)), pa.array(doc.astype(np.int32)), ids.take(pa.array(doc)),
                     pa.array(np.repeat([x[0] for x in out], n)), pa.array(starts - first[doc]),
                     pa.array(np.repeat([x[3] for x in out], n).astype(np.int32))],
                    ["shard", "ord", "doc_id", "phrase_id", "start", "length"])


def phrase_matches(index: DataFrame, phrases: DataFrame, slop: int = 0) -> DataFrame:
    """One row per match of a phrase (phrase_id, phrase) in a document of the index."""
    words = phrases.select("phrase_id", F.explode(F.split(F.col("phrase").cast("string"), " "))
                           .alias("word")).select("phrase_id", F.col("word").cast("binary").alias("term"))
    lists = stored(index.join(words.select("term").distinct(), "term", "left_semi"), "phrase-postings")
    total = lists.groupBy("term").agg(F.sum("n").alias("n"))
    rarest = (words.join(total, "term", "left").groupBy("phrase_id")
              .agg(F.min(F.struct("n", "term")).alias("r"), F.count_if(F.col("n").isNull()).alias("missing"))
              .filter("missing = 0").select("phrase_id", F.col("r.term").alias("term")))
    parts = max(1, math.ceil(phrases.count() / PHRASES_PER_TASK))
    part = F.pmod(F.xxhash64("phrase_id"), F.lit(parts))
    wanted = (lists.select("shard", "term").join(rarest, "term").join(phrases, "phrase_id")
              .select(F.col("shard").alias("at"), part.alias("slice"), "phrase_id", "phrase"))
    held = lists.unionByName(index.filter(F.col("term").isNull())).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))

    none = _empty(MATCHES)

    def run(left, right):
        return _search(left, right, slop, none) if left.num_rows else none

    return wanted.groupBy("at", "slice").cogroup(held.groupBy("shard", "part")).applyInArrow(run, MATCHES)


def _hit_words() -> F.Column:
    """Words inside any of the ``spans`` (structs start, stop)."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        F.array_sort("spans"), start,
        lambda a, s: F.struct(F.greatest(a["end"], s["stop"]).alias("end"),
                              (a["n"] + F.greatest(s["stop"] - F.greatest(a["end"], s["start"]),
                                                   F.lit(0).cast("long"))).alias("n")),
        lambda a: a["n"])


def contamination(docs: DataFrame, items: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """Per document: its words, the words inside benchmark windows, the items that
    occur (sorted) and whether the hits make up one ``share``-th of the words."""
    index = build_index(docs)
    owners = stored(item_phrases(items, window), "phrase-owners")
    phrases = stored(owners.select("phrase").distinct().withColumn("phrase_id", F.monotonically_increasing_id()),
                     "phrases")
    found = stored(phrase_matches(index, phrases), "phrase-matches")
    key = ["shard", "ord"]
    span = F.struct("start", (F.col("start") + F.col("length")).alias("stop"))
    hits = found.groupBy(key).agg(F.collect_set(span).alias("spans")).select(*key, _hit_words().alias("n_hit"))
    named = (found.select(*key, "phrase_id").distinct().join(phrases, "phrase_id").join(owners, "phrase")
             .groupBy(key).agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    docs_of = (index.filter(F.col("term").isNull())
               .select("shard", F.posexplode(F.arrays_zip("ids", "sizes")).alias("ord", "d"))
               .select(*key, F.col("d.ids").alias("doc_id"), F.col("d.sizes").alias("n_words")))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (docs_of.join(hits, key, "left").join(named, key, "left")
            .select("doc_id", "n_words", n_hit.alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated")))
