"""Substring dedup on words by difference-cover anchors.

With the cover D = {0, 1, 3} modulo 7, any two word positions can be moved by
one same shift below 7 onto positions whose residues are both in D.  So two
equal runs of 13 words share a 7-word anchor that starts at a cover position in
both documents.  Only anchors at cover positions are hashed (3 of 7):

1. every block sends its distinct anchor hashes; a bucket answers which of them
   two documents hold;
2. each shared anchor is extended to the 13-word windows that contain it; the
   blocks send each distinct window (96-bit hash) with the smallest doc_id
   that holds it, and a bucket answers where a smaller doc_id exists elsewhere;
3. the blocks delete the covered words.

Defined cases: null text has no words; a null doc_id sorts before all others;
rows with one doc_id never delete each other's words and each gives a row;
texts of fewer than 13 words keep everything; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm import blocks as bl
from strata.llm.textops import SPACES, Rolling, Words, covered, ramp, table

PERIOD, COVER = 7, (0, 1, 3)
_TABLE = table(SPACES, lower=False)
OUT = "doc_id long, n_words long, n_removed long, kept_text string"


class _Anchors:
    def __init__(self, block: bl.Block, window: int, n_buckets: int):
        self.words = w = Words(block.data, block.offs, *_TABLE)
        self.size = size = window - PERIOD + 1          # words of an anchor
        self.roll = Rolling(w.norm)
        first = w.first[:-1]
        inside = np.arange(w.n) - np.repeat(first, np.diff(w.first))
        left = np.repeat(w.first[1:], np.diff(w.first)) - np.arange(w.n)
        long = np.repeat(np.diff(w.first) >= window, np.diff(w.first))
        cover = np.zeros(PERIOD, bool)
        cover[list(COVER)] = True
        self.at = np.flatnonzero(cover[inside % PERIOD] & (left >= size) & long)
        self.doc = w.docs()
        self.left, self.inside = left, inside
        self.keyed = bl.Keyed(self.hash(self.at, size, self.roll), n_buckets)

    def hash(self, at: np.ndarray, n: int, roll: Rolling) -> np.ndarray:
        return roll.of(self.words.start[at], self.words.start[at + n] - 1)

    def windows(self, shared: np.ndarray, window: int) -> np.ndarray:
        """Starts of the windows that contain a shared anchor."""
        a = self.at[shared[self.keyed.inverse]]
        cand = covered(self.words.n, np.maximum(a - (window - self.size), 0),
                       a + 1 - np.maximum(a - (window - self.size), 0)) if len(a) else np.zeros(self.words.n, bool)
        return np.flatnonzero(cand & (self.left >= window))


def _window_keys(x: _Anchors, starts: np.ndarray, window: int, n_buckets: int):
    h = x.hash(starts, window, x.roll)
    keyed = bl.Keyed(h, n_buckets)
    check = np.zeros(len(keyed.key), np.uint32)
    check[keyed.inverse] = x.hash(starts, window, Rolling(x.words.norm, seed=2)).astype(np.uint32)
    return keyed, check


def _answer_smaller(t: pa.Table) -> pa.Table:
    """Bits: some block holds the window in a document with a smaller id."""
    key, sizes = bl.joined(t.column("keys"), np.uint64)
    check, _ = bl.joined(t.column("checks"), np.uint32)
    ids, _ = bl.joined(t.column("least"), np.int64)
    order = np.lexsort((check, key))
    k, c = key[order], check[order]
    first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])]))
    low = np.empty(len(key), np.int64)
    low[order] = np.repeat(np.minimum.reduceat(ids[order], first), np.diff(np.append(first, len(k))))
    return bl.bit_rows(t, sizes, low < ids, 2)


def dedup_substrings(docs: DataFrame, window: int = 13) -> DataFrame:
    """One row per document: words, removed words, and the kept words joined by a space."""
    if window < PERIOD:
        raise ValueError(f"window must be at least {PERIOD} words")
    n = bl.buckets(docs.sparkSession)
    blocks = bl.write_blocks(docs, "substring-blocks")

    def ask(number, block):
        x = _Anchors(block, window, n)
        return bl.ask_shared(number, x.keyed, block.ids[x.doc[x.at]])

    shared = bl.stored(bl.each_block(blocks, ask, bl.SHARED_SCHEMA).groupBy("bucket")
                       .applyInArrow(bl.answer_shared(1), bl.REPLY_SCHEMA), "substring-shared")

    def extend(number, block, replies):
        x = _Anchors(block, window, n)
        starts = x.windows(x.keyed.answers(replies, 1), window)
        keyed, check = _window_keys(x, starts, window, n)
        low = keyed.least(block.ids[x.doc[starts]])
        rows = [(b, number, keyed.key[s].tobytes(), check[s].tobytes(), low[s].tobytes())
                for b, s in keyed.slices()]
        cols = list(zip(*rows)) if rows else [[]] * 5
        return pa.table([pa.array(c, y) for c, y in zip(cols, (pa.int32(), pa.int64(), *[pa.binary()] * 3))],
                        ["bucket", "block", "keys", "checks", "least"])

    smaller = (bl.with_replies(blocks, shared, extend,
                               "bucket int, block long, keys binary, checks binary, least binary")
               .groupBy("bucket").applyInArrow(_answer_smaller, bl.REPLY_SCHEMA))
    replies = shared.unionByName(bl.stored(smaller, "substring-smaller"))

    def finish(number, block, replies):
        x = _Anchors(block, window, n)
        w = x.words
        starts = x.windows(x.keyed.answers(replies, 1), window)
        keyed, _ = _window_keys(x, starts, window, n)
        ids = block.ids[x.doc[starts]]
        hit = keyed.answers(replies, 2)[keyed.inverse] | (keyed.least(ids)[keyed.inverse] < ids)
        gone = covered(w.n, starts[hit], window)
        kept = np.ones(len(w.norm), bool)
        lost = np.flatnonzero(gone)
        kept[ramp(w.start[lost], w.start[lost + 1] - w.start[lost])] = False
        total = np.concatenate([[0], np.cumsum(gone)])[w.first]
        edge = w.start[w.first]
        out = [w.norm[a:b][kept[a:b]].tobytes()[:-1] for a, b in zip(edge[:-1], edge[1:])]
        return pa.table([block.out_ids(), pa.array(np.diff(w.first)), pa.array(np.diff(total)),
                         pa.array(out, pa.binary()).cast(pa.string())],
                        ["doc_id", "n_words", "n_removed", "kept_text"])

    return bl.with_replies(blocks, replies, finish, OUT)
