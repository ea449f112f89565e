"""Suffix dedup of bytes: threshold-bounded interval expansion on a
Burrows-Wheeler transform (``bwt``), spread over Spark by minimizers.

Every 50-byte window names its minimizer, the 19-byte gram of least hash among
its 32 grams, and its side: 16 more bytes before or behind the minimizer that it
holds too.  Equal windows name equal sides, at the same place.  So:

1. the blocks send their distinct sides; a bucket answers which of them two
   documents hold (a window without such a one is unique);
2. for shared sides the blocks send the fragments that their windows cover
   (50 to 81 bytes), each distinct one once with the smallest doc_id that holds
   it, to the bucket of its minimizer.  The bucket interns equal fragments and
   builds transforms of those whose sides have several forms; a side that would
   fill a transform alone is told apart by more bytes.  The breadth-first
   expansion stops at 50 bytes and leaves classes of equal 50-byte strings.  The
   bucket answers, per window, whether a smaller doc_id holds the string;
3. the blocks remove the covered bytes.

Defined cases: null text is empty; a null doc_id sorts before all others; rows
with one doc_id never remove each other's bytes and each gives a row; texts
shorter than the threshold stay whole; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm import blocks as bl
from strata.llm.bwt import long_prefix_classes
from strata.llm.textops import Rolling, group_starts, mix, ramp

GRAMS = 32                                    # grams of a window; a power of two
OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


#: Windows whose minimizers are sought at a time: their numbers stay in the processor's cache.
PIECE = 1 << 15
#: Tells the two sides of a minimizer apart.
LEFT = np.uint64(0x9E3779B97F4A7C15)


def _picks(roll: Rolling, gram: int) -> np.ndarray:
    """Place of the minimizer of every window (the first one of least hash), documents aside."""
    n = max(len(roll.sum) - gram - GRAMS + 1, 0)
    out = np.empty(n, np.uint32)
    for lo in range(0, n, PIECE):
        hi = min(lo + PIECE, n)
        best = roll.grams(gram, lo, hi + GRAMS - 1)
        best &= np.uint64(0xFFFFFFFF00000000)
        best |= np.arange(lo, hi + GRAMS - 1, dtype=np.uint64)
        step = 1
        while step < GRAMS:
            best = np.minimum(best[:-step], best[step:])
            step *= 2
        out[lo:hi] = best & np.uint64(0xFFFFFFFF)
    return out


class _Minimizers:
    """Runs of windows with one minimizer occurrence, in a block.

    The ``left`` first windows of a run hold the half of their bytes that counts
    before the minimizer, the others behind it; each side has a key.
    """

    def __init__(self, block: bl.Block, length: int, n_buckets: int):
        n, self.length, self.gram = len(block.data), length, length - GRAMS + 1
        self.roll = Rolling(block.data)
        pick = _picks(self.roll, self.gram)
        new = np.ones(len(pick), bool)
        new[1:] = pick[1:] != pick[:-1]
        new[block.offs[block.offs < len(pick)]] = True
        begin = np.flatnonzero(new)
        doc = np.searchsorted(block.offs, begin, "right") - 1
        count = np.minimum(np.append(begin[1:], n), block.offs[doc + 1] - length + 1) - begin
        run = np.flatnonzero(count > 0)
        self.begin, self.count, self.doc = begin[run], count[run], doc[run]
        self.pick = pick[self.begin].astype(np.int64)
        side = GRAMS // 2
        self.left = np.clip(self.pick - side - self.begin + 1, 0, self.count)
        self.before, self.behind = np.flatnonzero(self.left > 0), np.flatnonzero(self.left < self.count)
        at = np.concatenate([self.pick[self.before] - side, self.pick[self.behind]])
        key = self.roll.of(at, at + self.gram + side)
        key[:len(self.before)] ^= LEFT
        self.keyed = bl.Keyed(key, n_buckets)

    def asked(self, block: bl.Block) -> np.ndarray:
        """doc_id of every side."""
        return block.ids[self.doc[np.concatenate([self.before, self.behind])]]

    def fragments(self, shared: np.ndarray, n_buckets: int):
        """(begin, windows, document, place of the minimizer) of the runs' windows with shared
        sides, and their distinct fragments as Keyed.

        The key of a fragment hashes its bytes; its bucket is its minimizer's.
        """
        hit = shared[self.keyed.inverse]
        first, last = self.begin + self.left, self.begin + self.left
        runs = self.before[hit[:len(self.before)]]
        first[runs] = self.begin[runs]
        runs = self.behind[hit[len(self.before):]]
        last[runs] = self.begin[runs] + self.count[runs]
        runs = np.flatnonzero(last > first)
        begin, end, pick = first[runs], last[runs] - 1 + self.length, self.pick[runs]
        body = self.roll.of(begin, end)
        n = np.uint64(n_buckets)
        key = (body >> np.uint64(1)) // n * n + self.roll.of(pick, pick + self.gram) % n
        return begin, last[runs] - begin, self.doc[runs], pick - begin, bl.Keyed(key, n_buckets)


def _ask_fragments(number: int, block: bl.Block, x: _Minimizers, begin, count, doc, place, keyed) -> pa.Table:
    low = keyed.least(block.ids[doc])
    one = np.zeros(len(keyed.key), np.int64)
    one[keyed.inverse] = np.arange(len(begin))                       # a run that shows the fragment
    size = (count[one] - 1 + x.length).astype(np.uint8)
    place = place[one].astype(np.uint8)
    rows = []
    for b, s in keyed.slices():
        body = block.data[ramp(begin[one[s]], size[s].astype(np.int64))]
        rows.append((b, number, body.tobytes(), size[s].tobytes(), place[s].tobytes(), low[s].tobytes()))
    cols = list(zip(*rows)) if rows else [[]] * 6
    return pa.table([pa.array(c, y) for c, y in zip(cols, (pa.int32(), pa.int64(), *[pa.binary()] * 4))],
                    ["bucket", "block", "body", "size", "place", "least"])


class _Strings:
    """Byte ranges of at least eight bytes, read as eight-byte words (the last one overlaps)."""

    def __init__(self, body: np.ndarray):
        self.body = body
        self.words = np.ndarray((max(len(body) - 7, 0),), "<u8", body, 0, (1,))

    def hash(self, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        size = np.broadcast_to(np.asarray(size, np.int64), at.shape)
        out = size.astype(np.uint64)
        every = int(size.min(initial=200))
        for j in range(0, int(size.max(initial=0)), 8):
            more = slice(None) if j < every else np.flatnonzero(size > j)
            out[more] = mix(out[more] ^ self.words[at[more] + np.minimum(j, size[more] - 8)])
        return out

    def differ(self, at: np.ndarray, other: np.ndarray, size: np.ndarray) -> bool:
        """Some range at ``at`` is unlike the one of the same size at ``other``."""
        for j in range(0, int(size.max(initial=0)), 8):
            to = np.minimum(j, size - 8)
            if (self.words[at + to] != self.words[other + to]).any():
                return True
        return False


def _intern(text: _Strings, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a member of each class, class of every fragment) for equal fragments, compared by bytes."""
    h = text.hash(at, size)
    order = np.argsort(h)
    first = group_starts(h[order])
    one, cls = order[first], np.empty_like(order)
    cls[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(h))))
    like = np.flatnonzero(one[cls] != np.arange(len(at)))
    other = one[cls[like]]
    if (size[other] != size[like]).any() or text.differ(at[like], at[other], size[like]):
        cells = np.zeros((len(at), int(size.max()) + 1), np.uint8)   # equal hashes, other bytes
        cells[np.repeat(np.arange(len(at)), size), ramp(np.zeros_like(at), size)] = text.body[ramp(at, size)]
        cells[:, -1] = size
        _, one, cls = np.unique(cells, axis=0, return_index=True, return_inverse=True)
    return one, cls.reshape(-1)


def _interned(text: _Strings, at, size, low):
    """Distinct fragments: (a member, class of every fragment, smallest doc_id of each class)."""
    one, cls = _intern(text, at, size)
    lowest = np.full(len(one), np.iinfo(np.int64).max)
    np.minimum.at(lowest, cls, low)
    return one, cls, lowest


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members of the groups of several equal keys, and where each group begins among them (and the end)."""
    order = np.argsort(key, kind="stable")
    first = group_starts(key[order])
    size = np.diff(np.append(first, len(key)))
    order = order[np.repeat(size > 1, size)]
    return order, np.concatenate([[0], np.cumsum(size[size > 1])])


def _transformed(text: _Strings, at, size, low, key, length: int) -> np.ndarray:
    """Smallest doc_id that holds each window of the fragments; equal windows have equal keys."""
    one, cls, lowest = _interned(text, at, size, low)
    at, size, windows = at[one], size[one], size[one] - length + 1
    base = np.cumsum(windows) - windows
    out = np.repeat(lowest, windows)
    sel = np.sort(_groups(key[one])[0])                              # fragments that may share windows
    if len(sel):
        body = text.body[ramp(at[sel], size[sel])]
        names = np.unique(body)
        code = np.zeros(256, np.uint8)
        code[names] = np.arange(1, len(names) + 1)
        step = size[sel] + 1
        head = np.cumsum(step) - step
        t = np.zeros(int(step.sum()), np.uint8)
        t[ramp(head, size[sel])] = code[body]
        owner = np.repeat(np.arange(len(sel)), step)
        inside = np.arange(len(t)) - head[owner]
        tail = step[owner] - 1 - inside
        sa, same = long_prefix_classes(t, tail, int(size.max()) + 1, length)
        keep = tail[sa] >= length
        sa, same = sa[keep], same[keep]
        first = group_starts(same)
        least = np.minimum.reduceat(lowest[sel][owner[sa]], first)
        out[base[sel][owner[sa]] + inside[sa]] = np.repeat(least, np.diff(np.append(first, len(same))))
    return out[ramp(base[cls], windows[cls])]


#: Fragment bytes that one transform takes.
CHUNK_BYTES = 1 << 20


def _least_of_windows(text: _Strings, at, size, place, low, length: int, width: int = GRAMS) -> np.ndarray:
    """Smallest doc_id that holds each window of the fragments.

    The minimizer lies ``place`` bytes behind a fragment's begin, and in all its
    windows at one of ``width`` places.  Equal windows have it at the same place,
    so they share the bytes that all windows with one half of the places hold:
    only fragments that share such a string go to a transform, and those that
    share one that would fill a transform alone are told apart by ever fewer
    places, down to whole windows, which are interned.
    """
    one, cls, lowest = _interned(text, at, size, low)
    at, size, place = at[one], size[one], place[one]
    windows = size - length + 1
    base = np.cumsum(windows) - windows
    out = np.repeat(lowest, windows)
    half = width // 2
    if half and len(one) > 1:
        floor = place // width * width
        left = np.clip(place - floor - half + 1, 0, windows)
        before, behind = np.flatnonzero(left > 0), np.flatnonzero(left < windows)
        own = np.concatenate([before, behind])
        skip = np.concatenate([np.zeros_like(before), left[behind]])
        n = np.concatenate([left[before], (windows - left)[behind]])
        nearest = floor[own]
        nearest[:len(before)] += half
        key = text.hash(at[own] + place[own] - nearest, length - half + 1)
        key[:len(before)] ^= LEFT
        order, edges = _groups(key)
        own, skip, n, key = own[order], skip[order], n[order], key[order]
        to, begin, bytes_ = base[own] + skip, at[own] + skip, n + length - 1
        total = np.concatenate([[0], np.cumsum(bytes_)])[edges]
        for lo, hi in bl.cuts(np.diff(total), CHUNK_BYTES):          # whole groups
            s = slice(edges[lo], edges[hi])
            if total[hi] - total[lo] > CHUNK_BYTES:
                least = _least_of_windows(text, begin[s], bytes_[s], place[own[s]] - skip[s], lowest[own[s]],
                                          length, half)
            else:
                least = _transformed(text, begin[s], bytes_[s], lowest[own[s]], key[s], length)
            out[ramp(to[s], n[s])] = least
    return out[ramp(base[cls], windows[cls])]


def _answer_windows(length: int):
    def run(t: pa.Table) -> pa.Table:
        body, _ = bl.joined(t.column("body"), np.uint8)
        size, rows = bl.joined(t.column("size"), np.uint8)
        place, _ = bl.joined(t.column("place"), np.uint8)
        low, _ = bl.joined(t.column("least"), np.int64)
        text, size, place = _Strings(body), size.astype(np.int64), place.astype(np.int64)
        at = np.cumsum(size) - size
        windows = size - length + 1
        ends = np.cumsum(windows)
        bits = np.zeros(int(ends[-1]), bool)
        gram = text.hash(at + place, length - GRAMS + 1)
        order = np.argsort(gram, kind="stable")
        groups = np.append(group_starts(gram[order]), len(order))
        total = np.concatenate([[0], np.cumsum(size[order])])[groups]
        cut = np.append(group_starts(total[:-1] // CHUNK_BYTES), len(groups) - 1)
        for lo, hi in zip(groups[cut[:-1]], groups[cut[1:]]):        # whole minimizers
            own = np.sort(order[lo:hi])
            least = _least_of_windows(text, at[own], size[own], place[own], low[own], length)
            mine = windows[own]
            bits[ramp(ends[own] - mine, mine)] = least < np.repeat(low[own], mine)
        return bl.bit_rows(t, np.add.reduceat(windows, np.cumsum(rows) - rows), bits, 2)
    return run


def _covered(size: int, hit: np.ndarray, length: int) -> np.ndarray:
    """Flags of the bytes of the windows that begin at ``hit``, in order and without repeats."""
    d = np.zeros(size + 1, np.int8)
    d[hit] = 1
    d[hit + length] -= 1
    return np.cumsum(d[:-1], dtype=np.int32) > 0


def dedup_suffixes(docs: DataFrame, length: int = 50) -> DataFrame:
    """One row per document: bytes, removed bytes, removed runs and the bytes kept."""
    if not GRAMS + 7 <= length <= 200:
        raise ValueError(f"length must be {GRAMS + 7} to 200 bytes")
    n = bl.buckets(docs.sparkSession)
    blocks = bl.write_blocks(docs, "suffix-blocks")

    def ask(number, block):
        x = _Minimizers(block, length, n)
        return bl.ask_shared(number, x.keyed, x.asked(block))

    shared = bl.stored(bl.each_block(blocks, ask, bl.SHARED_SCHEMA).groupBy("bucket")
                       .applyInArrow(bl.answer_shared(1), bl.REPLY_SCHEMA), "suffix-shared")

    def send(number, block, replies):
        x = _Minimizers(block, length, n)
        return _ask_fragments(number, block, x, *x.fragments(x.keyed.answers(replies, 1), n))

    found = (bl.with_replies(blocks, shared, send, "bucket int, block long, body binary, size binary, "
                             "place binary, least binary")
             .groupBy("bucket").applyInArrow(_answer_windows(length), bl.REPLY_SCHEMA))
    replies = shared.unionByName(bl.stored(found, "suffix-windows"))

    def finish(number, block, replies):
        x = _Minimizers(block, length, n)
        begin, count, doc, _, keyed = x.fragments(x.keyed.answers(replies, 1), n)
        ids = block.ids[doc]
        per_key = np.zeros(len(keyed.key), np.int64)
        per_key[keyed.inverse] = count
        bits = keyed.answers(replies, 2, per_key)
        base = np.cumsum(per_key) - per_key
        here = np.repeat(keyed.least(ids)[keyed.inverse] < ids, count)
        hit = bits[ramp(base[keyed.inverse], count)] | here
        gone = _covered(len(block.data), ramp(begin, count)[hit], length)
        starts = gone.copy()
        starts[1:] &= ~gone[:-1]
        edge = block.offs[:-1][block.offs[:-1] < len(gone)]
        starts[edge] = gone[edge]
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[block.offs])
        ends = np.concatenate([[0], np.cumsum(np.diff(block.offs) - removed)])
        kept = pa.Array.from_buffers(pa.large_binary(), len(block.ids),
                                     [None, pa.py_buffer(ends), pa.py_buffer(block.data[~gone])]).cast(pa.binary())
        return pa.table([block.out_ids(), pa.array(np.diff(block.offs)), pa.array(removed),
                         pa.array(np.diff(np.concatenate([[0], np.cumsum(starts)])[block.offs])), kept],
                        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return bl.with_replies(blocks, replies, finish, OUT)
