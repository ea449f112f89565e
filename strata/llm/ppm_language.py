"""Language ID by prediction by partial matching over bytes.

One context tree per language, contexts of zero to three bytes, escape method
C: a context seen T times with D different next bytes gives a seen byte the
share n / (T + D) and the step to the next shorter context D / (T + D); below
the empty context all 256 bytes are alike.  The statistics are frozen after
training, so the code length of a byte depends on it and the three bytes before
it only; each order keeps the strings that some language has seen, sorted, with
their exact code lengths in every language, and nothing for the others: a byte not
found there pays its context's escape and is looked up one order lower.  ASCII
letters count in lower case.  A text gets the language with the shortest code.

``DOCS_PER_LANGUAGE`` bounds the training sample (about that many documents of
each language, taken by a hash of the id), and with it the trees that go to the
tasks.  Everything else covers all documents.

Defined cases: null text, or text without a letter, is ``und`` with score 0;
so is everything where no language was learned; ties go to the first language
by name; texts are scored whole, piece by piece, whatever their length; every input
row gives a row, an empty table none; extra columns are kept or ignored as the
function says, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.blocks import limit_batches, texts
from strata.llm.rows import free_name
from strata.llm.textops import column_bytes, ramp

DOCS_PER_LANGUAGE = 2000
SYMBOLS = 256
ORDER = 3
PIECE = 1 << 20
_LOWER = np.arange(256, dtype=np.int64)
_LOWER[65:91] += 32


def _grams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four-byte strings ending at every byte (spaces before a text) and its text."""
    sizes = np.diff(offs)
    wide = np.full(len(data) + 3 * len(sizes), 32, np.int64)
    at = ramp(offs[:-1] + 3 * np.arange(1, len(sizes) + 1), sizes)
    wide[at] = _LOWER[data]
    doc = np.repeat(np.arange(len(sizes)), sizes)
    return ((wide[at - 3] << 24) | (wide[at - 2] << 16) | (wide[at - 1] << 8) | wide[at]), doc


class Level:
    """Frozen code lengths of the bytes that some language has seen after contexts of ``order`` bytes."""

    def __init__(self, order: int, lang: np.ndarray, gram: np.ndarray, count: np.ndarray, n: int, lower):
        self.mask = (1 << 8 * (order + 1)) - 1
        self.keys, at = np.unique(gram & self.mask, return_inverse=True)
        seen = np.zeros((len(self.keys), n))
        np.add.at(seen, (at, lang), count)
        self.contexts, ctx = np.unique(self.keys >> 8, return_inverse=True)
        t, d = np.zeros((len(self.contexts), n)), np.zeros((len(self.contexts), n))
        np.add.at(t, ctx, seen)
        np.add.at(d, ctx, seen > 0)
        escape = np.log2(np.where(t > 0, (t + d) / np.maximum(d, 1), 1))
        with np.errstate(divide="ignore", invalid="ignore"):
            bits = np.where(seen > 0, np.log2((t + d)[ctx] / seen), escape[ctx] + lower(self.keys))
        self.escape, self.bits = escape.astype(np.float32), bits.astype(np.float32)


def _found(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the sorted ``keys``, whether it is there)."""
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return at, keys[at] == asked


class Trees:
    """Frozen code lengths (bits) of all languages."""

    def __init__(self, langs: list[str], lang: np.ndarray, gram: np.ndarray, count: np.ndarray):
        self.langs, self.levels = langs, []
        for order in range(ORDER + 1):
            self.levels.append(Level(order, lang, gram, count, len(langs), lambda k, o=order: self._bits(k, o - 1)))

    def _bits(self, gram: np.ndarray, order: int) -> np.ndarray:
        """Code lengths [strings, language] of the last byte of each string after up to ``order`` bytes."""
        if order < 0:
            return np.full((len(gram), len(self.langs)), np.log2(SYMBOLS), np.float32)
        level = self.levels[order]
        key = gram & level.mask
        at, there = _found(level.keys, key)
        out = level.bits[at]
        miss = np.flatnonzero(~there)
        if len(miss):
            at, there = _found(level.contexts, key[miss] >> 8)
            out[miss] = np.where(there[:, None], level.escape[at], 0) + self._bits(gram[miss], order - 1)
        return out

    def lengths(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Code length of every text in every language, in bits."""
        out = np.zeros((len(offs) - 1, len(self.langs)))
        for lo in range(0, len(data), PIECE):
            hi = min(lo + PIECE, len(data))
            first = max(lo - ORDER, 0)                                 # context from before the piece
            part = np.clip(offs, first, hi) - first
            gram, doc = _grams(data[first:hi], part)
            gram, doc = gram[lo - first:], doc[lo - first:]
            bits = self._bits(gram, ORDER)
            edge = np.flatnonzero(np.diff(doc, prepend=-1))
            if len(edge):
                out[doc[edge]] += np.add.reduceat(bits, edge, axis=0, dtype=np.float64)
        return out

    def best(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language index, its share when code lengths are turned into probabilities)."""
        bits = self.lengths(data, offs)
        least = bits.min(1, keepdims=True)
        share = np.exp2(np.maximum(least - bits, -1000))
        return bits.argmin(1), 1 / share.sum(1)


def fit_languages(labelled: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> Trees | None:
    """Trees from rows (doc_id, text, lang); None where there are none."""
    spark = labelled.sparkSession
    rows = labelled.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = rows.groupBy("lang").agg(F.least(F.lit(1.0), docs_per_language / F.count(F.lit(1))).alias("share"))
    shares = {r["lang"]: r["share"] for r in share.collect()}          # one row per language
    if not shares:
        return None
    langs = sorted(shares)
    bound = F.element_at(F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(shares[k]))]), F.col("lang"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(1 << 30)
    index = {k: i for i, k in enumerate(langs)}

    def count(batches):
        for b in batches:
            gram, doc = _grams(*column_bytes(b.column("text")))
            lang = np.array([index[x] for x in b.column("lang").to_pylist()], np.int64)
            key, n = np.unique((lang[doc] << 32) | gram, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

    limit_batches(spark)
    t = (rows.filter(place < bound).select("text", "lang").mapInArrow(count, "key long, n long")
         .groupBy("key").agg(F.sum("n").alias("n"))
         .toArrow())                                                   # strings of a bounded sample
    key, n = (t.column(c).to_numpy().astype(np.int64) for c in ("key", "n"))
    order = np.argsort(key)
    return Trees(langs, key[order] >> 32, key[order] & 0xFFFFFFFF, n[order]) if len(key) else None


def _letters() -> F.Column:
    return F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False))


def _predict(trees, b: pa.RecordBatch, letters: pa.Array) -> tuple[pa.Array, pa.Array]:
    trees = trees.value if trees is not None else None
    if trees is None:
        return pa.array(["und"] * b.num_rows, pa.string()), pa.array(np.zeros(b.num_rows))
    best, score = trees.best(*column_bytes(b.column("text").cast(pa.string())))
    return (pc.if_else(letters, pa.array(trees.langs, pa.string()).take(pa.array(best)), "und"),
            pc.if_else(letters, pa.array(score), 0.0))


def identify(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """doc_id, lang_pred and score of every row."""
    sent = None if trees is None else docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        for b in batches:
            lang, score = _predict(sent, b, b.column("letters"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), lang, score], ["doc_id", "lang_pred", "score"])

    limit_batches(docs.sparkSession, 512)
    return texts(docs).withColumn("letters", _letters()).mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, trees: Trees | None, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with a score of ``least``."""
    sent = None if trees is None else docs.sparkSession.sparkContext.broadcast(trees)
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            text = pa.RecordBatch.from_arrays([b.column(at)], ["text"])
            lang, score = _predict(sent, text, b.column(b.num_columns - 1))
            good = pc.and_(pc.not_equal(lang, "und"), pc.greater_equal(score, least))
            yield pa.RecordBatch.from_arrays(b.columns[:-1], schema=pa.schema(list(b.schema)[:-1])).filter(good)

    limit_batches(docs.sparkSession, 512)
    # plain names on the way through Python, which takes no dots in them
    plain = [f"c{i}" for i in range(len(docs.columns))]
    kinds = T.StructType([T.StructField(n, f.dataType, f.nullable, f.metadata)
                          for n, f in zip(plain, docs.schema.fields)])
    marked = docs.select("*", _letters().alias(free_name(docs, "letters"))).toDF(*plain, "letters")
    return marked.mapInArrow(run, kinds).toDF(*docs.columns)
