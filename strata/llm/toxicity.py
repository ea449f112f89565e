"""Toxicity by two class-conditional Kneser-Ney models.

Words are lower-case runs of letters, digits and bytes above ASCII.  The model of a
class gives a word its share of the class's counts (in how many of its texts the
word is), less an absolute discount.  What the discount takes off goes to the level
below, which both classes share: the continuation counts (after how many different
words a word was seen, in either class), discounted themselves in favour of all
words alike, the unknown one included.  The shares of either model sum to one.  An
expression that a class has in up to ``DISCOUNT`` texts is known through the shared
counts alone, as an unknown one is.

The two models are compared by log-likelihood per word, log P1 - log P0 divided by
the number of words, twice: over every word of the whole text, toxic, ordinary or
unknown, each as often as it stands there, and over the passage that tells most, the
``EXPRESSIONS`` words of the text that are the most toxic by it (an expression that is
more ordinary than an unknown word counts as one there).  A logistic curve on both and
the text's length gives the score.  (The whole text alone misses most texts with a few
toxic words among some hundred ordinary ones; README has the figures.)

All labelled rows of the training fold are counted, but those that fit the curve: at
most about ``CALIBRATION`` of them, and a fifth where there are fewer.

Counting is two aggregates, over distinct word pairs and then over words, without a
bound.  Scoring takes one pass over the texts: it keeps, per block, which words that
may differ from an unknown one are in which text, asks once for the evidence of the
block's distinct words (see ``lookups``), adds it up over each text and takes the
strongest.  Blocks are large (``BLOCK``), so that common words are asked for seldom.  A
Bloom filter of fixed size spares asking for most words that are like an unknown one;
results do not depend on it.

A task holds, per text and distinct word of its block, a place among the words of a piece
of ``PIECE`` bytes and a count, four bytes each; whatever needs more is done piece by piece,
and what it sends goes in batches of ``SENT_ROWS``.  So its memory follows ``BLOCK`` and not
the number of words with evidence.

Defined cases: a null or empty text has the values of an unknown word; without rows
of both classes all scores are 0; a document with several label rows counts once
per row, null labels are not learned from; repeated ids are documents of their own;
texts are scored whole, whatever their length; every input row gives a row, an empty
table none; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.blocks import column_ids, cuts, ids_out, limit_batches, stored, texts
from strata.llm.folds import may_learn
from strata.llm.lookups import ASK_SCHEMA, Shape, answers, ask, ask_table, received
from strata.llm.textops import NON_WORD, Rolling, Words, column_bytes, group_starts, mix, table

DISCOUNT = 2.0
SHARED_DISCOUNT = 0.75
EXPRESSIONS = 3
CALIBRATION = 20_000
FILTER_BITS = 1 << 25            # Bloom filter of the words with evidence: 4 MiB whatever the vocabulary
UNIT = 1 << 20                   # evidence is kept in whole units, so that sums have no order
PIECE = 1 << 18                  # bytes of text hashed at a time
PAIRS_PIECE = 1 << 23            # bytes of text whose word pairs are sent once
SENT_ROWS = 1 << 16              # rows of word pairs sent at a time
BLOCK = 1 << 25                  # bytes of text whose words are asked for once
ENTRIES = 1 << 18                # words of texts whose evidence is added up at a time
ROW_BYTES = 16                   # what a row adds to a block besides its text
_TABLE = table(NON_WORD, lower=True)
_BIT = np.packbits(np.eye(8, dtype=bool), axis=1).ravel()
_SIGN = np.uint64((1 << 63) - 1)
KEPT = ("block long, n_keys long, ids binary, tag binary, n binary, keys binary, bucket binary, "
        "held binary, step binary, times binary")
VALUES = "doc_id long, tag int, value double, n long, mean double"


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative 63-bit hash of every word, and its text."""
    w = Words(data, offs, *_TABLE)
    h = Rolling(w.norm).of(w.start[:-1], w.start[1:] - 1) & _SIGN
    return h.view(np.int64), w.docs()


# ---- counting ------------------------------------------------------------

def _zipped(sent):
    """doc_id and compressed text of the rows whose id may have a label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, size = sent.value
        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            one, two = _places(column_ids(b.column("doc_id")), size)
            b = b.filter(pa.array(_bit_set(packed, one) & _bit_set(packed, two)))
            body = [z.compress(x or b"") for x in b.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(body, pa.binary())], ["doc_id", "body"])
    return run


def _distinct_pairs(parts: list[tuple]) -> pa.RecordBatch:
    """Of the pieces (pair, word, first, toxic), which leave the list."""
    pair, w, first, toxic = map(np.concatenate, zip(*parts))
    parts.clear()
    order = np.lexsort((w, pair))
    one = group_starts(pair[order], w[order])
    return pa.RecordBatch.from_arrays(
        [pa.array(pair[order][one]), pa.array(w[order][one]),
         *[pa.array(np.add.reduceat((first & side)[order].astype(np.int32), one), pa.int32()) for side in (~toxic, toxic)]],
        ["pair", "word", "n0", "n1"])


def _slices(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return (b.slice(i, SENT_ROWS) for i in range(0, b.num_rows, SENT_ROWS))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (pair, word) of a piece of texts, 0 before a text's first word.  n0 and n1: texts of each
    class that have the word, entered at the pair of its first place in the text."""
    z, parts, held = zstandard.ZstdDecompressor(), [], 0
    for b in batches:
        label = b.column("toxic").to_numpy(zero_copy_only=False)
        data, offs = column_bytes(pa.array([z.decompress(x) for x in b.column("body").to_pylist()], pa.binary()))
        for lo, hi in cuts(np.diff(offs), PIECE):
            w, doc = word_hashes(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
            if not len(w):
                continue
            before = np.concatenate([[0], w[:-1]])
            before[np.diff(doc, prepend=-1) != 0] = 0
            by_word = np.lexsort((w, doc))                            # stable: places in order
            first = np.zeros(len(w), bool)
            first[by_word[group_starts(doc[by_word], w[by_word])]] = True
            pair = mix(before.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ w.view(np.uint64)).view(np.int64)
            parts.append((pair, w, first, (label[lo:hi] == 1)[doc]))
            held += int(offs[hi] - offs[lo])
            if held >= PAIRS_PIECE:
                yield from _slices(_distinct_pairs(parts))
                held = 0
    if parts:
        yield from _slices(_distinct_pairs(parts))


def word_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """key (word), n0, n1 (texts of each class that have it) and c (different words before it), of labelled texts."""
    limit_batches(docs.sparkSession)
    # only texts that may have a label move to the labels, compressed; the filter's misses fall to the join
    bits = bloom_filter(labels.select(F.col("doc_id").alias("key")), FILTER_BITS)
    sent = docs.sparkSession.sparkContext.broadcast((np.packbits(bits), len(bits)))
    moved = docs.mapInArrow(_zipped(sent), "doc_id long, body binary")
    pairs = (moved.hint("merge").join(labels, "doc_id").select("body", "toxic")
             .mapInArrow(_pairs, "pair long, word long, n0 int, n1 int")
             .groupBy("pair", "word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))
    return pairs.groupBy(F.col("word").alias("key")).agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.count(F.lit(1)).alias("c"))


@dataclass
class Shares:
    """The two models: counts in all, and what the discounts leave to the level below."""

    counts: tuple[int, int]              # of each class
    left: tuple[float, float]            # discounted from each class
    shared: int                          # continuation counts of both together
    shared_left: float
    words: int                           # different words of both

    def shared_share(self, c):
        return (np.maximum(c - SHARED_DISCOUNT, 0) + self.shared_left / (self.words + 1)) / self.shared

    def share(self, i: int, n, c):
        """P(word) in class ``i`` of a word in ``n`` texts there, with continuation count ``c`` (0, 0: the unknown word)."""
        return (np.maximum(n - DISCOUNT, 0) + self.left[i] * self.shared_share(c)) / self.counts[i]

    def difference(self, n0, n1, c):
        return np.log(self.share(1, n1, c)) - np.log(self.share(0, n0, c))

    @property
    def unknown(self) -> int:
        """Evidence of an unknown word, in units."""
        zero = np.zeros(1)
        return int(np.rint(self.difference(zero, zero, zero)[0] * UNIT))


def shares(counts: DataFrame) -> Shares | None:
    """The models from the counts: one row of sums reaches the driver."""
    def less(c: str, d: float) -> Column:
        # quarters are exact in a double, so the sum has no order
        return F.sum(F.least(F.col(c).cast("double"), F.lit(d)))

    t = counts.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("c").alias("c"), less("n0", DISCOUNT).alias("l0"),
                   less("n1", DISCOUNT).alias("l1"), less("c", SHARED_DISCOUNT).alias("l"), F.count(F.lit(1)).alias("n")).first()
    if not t["n0"] or not t["n1"]:
        return None
    return Shares((t["n0"], t["n1"]), (t["l0"], t["l1"]), t["c"], t["l"], t["n"])


def _evidence(s: Shares):
    """key and units (log P1 - log P0 beyond an unknown word's) of all words that differ from an unknown one.
    The rest, in up to ``DISCOUNT`` texts of either class, has an unknown word's evidence exactly."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n0, n1, c = (b.column(x).to_numpy().astype(np.float64) for x in ("n0", "n1", "c"))
            units = np.rint(s.difference(n0, n1, c) * UNIT).astype(np.int64) - s.unknown
            differs = units != 0
            yield pa.RecordBatch.from_arrays([b.column("key").filter(pa.array(differs)), pa.array(units[differs])], ["key", "units"])
    return run


def _places(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    return key % size, (key >> 31) % size


def _bit_set(packed: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether the bits are set at these places; the bits stay packed (see ``np.packbits``)."""
    return packed[place >> 3] & _BIT[place & 7] != 0


def _filter_part(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, bool)
        for b in batches:
            for place in _places(b.column("key").to_numpy(), size):
                bits[place] = True
        if bits.any():
            packed = np.packbits(bits)
            lo = np.arange(0, len(packed), 1 << 16)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lo), pa.array([packed[i:i + (1 << 16)].tobytes() for i in lo], pa.binary())], ["at", "bits"])
    return run


def bloom_filter(evidence: DataFrame, size: int) -> np.ndarray:
    """``size`` bits of the words of ``evidence``: every task's bits, joined piece by piece."""
    def merged(t: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_py(), np.uint8) for x in t.column("bits")]
        return pa.table([t.column("at").slice(0, 1), pa.array([np.bitwise_or.reduce(parts).tobytes()], pa.binary())], ["at", "bits"])

    rows = (evidence.select("key").coalesce(64).mapInArrow(_filter_part(size), "at long, bits binary")
            .groupBy("at").applyInArrow(merged, "at long, bits binary").collect())
    out = np.zeros(-(-size // 8), np.uint8)
    for r in rows:
        out[r["at"]:r["at"] + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return np.unpackbits(out, count=size).astype(bool)


@dataclass
class Model:
    """Stored evidence of all words that differ from an unknown one, its filter, and the curve from values to score."""

    shares: Shares
    evidence: DataFrame          # key, units
    words: int                   # rows of evidence
    bits: np.ndarray
    curve: tuple[float, float, float, float] = (0.0, 1.0, 1.0, 0.0)


# ---- scoring -------------------------------------------------------------

def _packed(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).data.cast("B") if x.size else b"")


def _unpacked(cell, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(cell.as_py()), dtype)


def _planes(x: np.ndarray) -> bytes:
    """int32 numbers, first all low bytes: small ones pack well."""
    return _packed(x.astype("<i4").view(np.uint8).reshape(-1, 4).T)


def _numbers(cell) -> np.ndarray:
    return _unpacked(cell, np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()


def _words_of(data: np.ndarray, offs: np.ndarray, packed: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Of the texts: number of words, and of different words that pass the filter; these words; and every text's:
    places among them and times."""
    w, doc = word_hashes(data, offs)
    n_texts = len(offs) - 1
    n = np.bincount(doc, minlength=n_texts).astype(np.int64)
    one, two = _places(w, size)
    keep = np.flatnonzero(_bit_set(packed, one))
    keep = keep[_bit_set(packed, two[keep])]
    keys, at = np.unique(w[keep], return_inverse=True)
    # one number for text and word
    held, times = np.unique(doc[keep] * max(len(keys), 1) + at, return_counts=True)
    doc, at = np.divmod(held, max(len(keys), 1))
    return n, np.bincount(doc, minlength=n_texts).astype(np.int64), keys, at.astype(np.int32), times.astype(np.int32)


def _block_row(number: int, shape: Shape, parts: list[tuple]) -> pa.RecordBatch:
    """The block of the pieces, which leave the list."""
    ids, tag, n, held = (np.concatenate(x) for x in list(zip(*parts))[:4])
    keys = np.unique(np.concatenate([p[4] for p in parts]))
    texts_with = np.zeros(len(keys), np.int64)
    for *_, words, at, _ in parts:
        texts_with[np.searchsorted(keys, words)] += np.bincount(at, minlength=len(words))
    common = np.argsort(-texts_with, kind="stable")           # common words get small numbers
    rank = np.empty(len(keys), np.int64)
    rank[common] = np.arange(len(keys))
    step, times = (np.empty(int(held.sum()), np.int32) for _ in range(2))
    done = 0
    for *_, of_text, words, at, many in parts:
        doc, at = np.repeat(np.arange(len(of_text)), of_text), rank[np.searchsorted(keys, words)][at]
        order = np.lexsort((at, doc))
        at = at[order]
        some = slice(done, done + len(at))
        step[some], times[some] = np.diff(at, prepend=0), many[order]
        first = group_starts(doc)
        step[some][first] = at[first]
        done += len(at)
    parts.clear()
    keys = keys[common]
    row = (number, len(keys), _packed(ids), _packed(tag), _packed(n), _packed(keys),
           _packed(shape.bucket(keys).astype(np.int32)), _packed(held), _planes(step), _planes(times))
    return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, _KINDS)], _NAMES)


def _kept(sent, shape: Shape):
    """Per block the texts' word numbers, the distinct words that pass the filter, and each text's: numbers among
    them, as steps from one to the next, and times."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, size = sent.value
        number = TaskContext.get().partitionId() << 33
        parts, held = [], 0
        for b in batches:
            data, offs = column_bytes(b.column("text"))
            ids = column_ids(b.column("doc_id"))
            tag = b.column("tag").fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32)
            for lo, hi in cuts(np.diff(offs), PIECE):
                parts.append((ids[lo:hi], tag[lo:hi],
                              *_words_of(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], packed, size)))
                held += int(offs[hi] - offs[lo]) + ROW_BYTES * (hi - lo)
                if held >= BLOCK:
                    yield _block_row(number, shape, parts)
                    number, held = number + 1, 0
        if parts:
            yield _block_row(number, shape, parts)
    return run


_NAMES = [c.split()[0] for c in KEPT.split(", ")]
_KINDS = [pa.int64(), pa.int64(), *[pa.binary()] * 8]


def _asks(shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                yield from ask_table(list(ask(shape, b.column("block")[i].as_py(),
                                              _unpacked(b.column("keys")[i], np.int64)))).to_batches()
    return run


def strongest(doc: np.ndarray, units: np.ndarray, times: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sum of the ``EXPRESSIONS`` largest units of every text; those below 0 and words beside the listed ones have 0."""
    up = units > 0
    doc, units, times = doc[up], units[up], np.minimum(times[up], EXPRESSIONS)
    doc, units = np.repeat(doc, times), np.repeat(units, times)
    order = np.lexsort((-units, doc))
    doc, units = doc[order], units[order]
    rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
    out = np.zeros(len(n), np.int64)
    np.add.at(out, doc[rank < EXPRESSIONS], units[rank < EXPRESSIONS])
    return out


def _sums(evidence: np.ndarray, step: np.ndarray, times: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units of all listed words of every text, and of its strongest."""
    ends = np.cumsum(held)
    run_sum = np.concatenate([[0], np.cumsum(step, dtype=np.int64)])
    units = evidence[run_sum[1:] - np.repeat(run_sum[ends - held], held)]
    run_sum = np.concatenate([[0], np.cumsum(units * times)])
    return run_sum[ends] - run_sum[ends - held], strongest(np.repeat(np.arange(len(held)), held), units, times, held)


def _text_values(shape: Shape, unknown: int):
    names = [c.split()[0] for c in VALUES.split(", ")]
    kinds = (pa.int64(), pa.int32(), pa.float64(), pa.int64(), pa.float64())

    def run(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        out = [pa.table([pa.array([], k) for k in kinds], names)]
        for i in range(blocks.num_rows):
            cell = {c: blocks.column(c)[i] for c in blocks.column_names}
            n, ids, held = (_unpacked(cell[c], np.int64) for c in ("n", "ids", "held"))
            # a bucket's number falls into that bucket itself, so it stands for the key
            evidence = received(shape, _unpacked(cell["bucket"], np.int32).astype(np.int64), replies, 1)[0]
            step, times = _numbers(cell["step"]), _numbers(cell["times"])
            ends = np.cumsum(held)
            whole, best = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
            for lo, hi in cuts(held, ENTRIES):
                whole[lo:hi], best[lo:hi] = _sums(evidence, step[ends[lo] - held[lo]:ends[hi - 1]],
                                                  times[ends[lo] - held[lo]:ends[hi - 1]], held[lo:hi])
            tag = _unpacked(cell["tag"], np.int32)
            value = (best / np.clip(n, 1, EXPRESSIONS) + unknown) / UNIT
            mean = (whole / np.maximum(n, 1) + unknown) / UNIT
            out.append(pa.table([ids_out(ids), pa.array(tag, pa.int32(), mask=tag < 0), pa.array(value), pa.array(n),
                                 pa.array(mean)], names))
        return pa.concat_tables(out)
    return run


def values(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, tag, n (words), mean (log P1 - log P0 per word of the whole text) and value (of its strongest words)
    of every row (doc_id, text, tag)."""
    limit_batches(rows.sparkSession)
    sent = rows.sparkSession.sparkContext.broadcast((np.packbits(model.bits), len(model.bits)))
    kept = stored(rows.mapInArrow(_kept(sent, Shape(model.words, 0)), KEPT), "toxic-words")
    shape = Shape(model.words, kept.agg(F.sum("n_keys")).first()[0] or 0)
    asks = kept.select("block", "keys").mapInArrow(_asks(shape), ASK_SCHEMA)
    replies = answers(shape, asks, model.evidence, ["units"])
    return (kept.drop("n_keys", "keys").groupBy("block").cogroup(replies.groupBy("block"))
            .applyInArrow(_text_values(shape, model.shares.unknown), VALUES))


def fit_toxicity(docs: DataFrame, labels: DataFrame, filter_bits: int = FILTER_BITS) -> Model | None:
    """The model from labelled rows of the training fold; None where a class has no words."""
    label = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("toxic").isin(0, 1) & may_learn()))
    share = min(0.2, CALIBRATION / max(label.count(), 1))
    curve_row = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 30)) < int((1 << 30) * share)
    base = texts(docs).filter(may_learn())
    counts = stored(word_counts(base.filter(~curve_row), label.filter(~curve_row)), "toxic-counts")
    s = shares(counts)
    if s is None:
        return None
    evidence = stored(counts.mapInArrow(_evidence(s), "key long, units long"), "toxic-evidence")
    model = Model(s, evidence, evidence.count(), bloom_filter(evidence, filter_bits))
    rows = (base.filter(curve_row).hint("merge").join(label.filter(curve_row), "doc_id")
            .select("doc_id", "text", F.col("toxic").alias("tag")))
    found = values(rows, model).orderBy("doc_id", "tag", "value", "mean", "n").toArrow()       # the bounded sample
    model.curve = fit_curve(*[found.column(c).to_numpy().astype(np.float64) for c in ("value", "mean", "n", "tag")])
    return model


def fit_curve(value: np.ndarray, mean: np.ndarray, n: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float, float]:
    """Shift, slopes on the strongest words, on the whole text and on log(1 + words): penalised logistic regression,
    Newton steps."""
    if not len(value):
        return 0.0, 1.0, 1.0, 0.0
    x = np.stack([np.ones_like(value), value, mean, np.log1p(n)])
    beta = np.zeros(4)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(beta @ x, -30, 30)))
        grad = x @ (toxic - p) - 1e-3 * beta
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-3 * np.eye(4), grad)
        size = np.abs(step).max()
        beta += step / max(1.0, size)
        if size < 1e-8:
            break
    return tuple(float(b) for b in beta)


def score_toxicity(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score and n_words of every row."""
    if model is None:
        return texts(docs).select("doc_id", F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_words"))
    shift, slope, whole, length = model.curve
    z = shift + slope * F.col("value") + whole * F.col("mean") + length * F.log1p("n")
    score = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(50.0)), F.lit(-50.0))))
    return (values(texts(docs).withColumn("tag", F.lit(None).cast("int")), model)
            .select("doc_id", score.alias("score"), F.col("n").alias("n_words")))
