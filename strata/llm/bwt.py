"""Repeated strings of a set of fragments from its Burrows-Wheeler transform.

``long_prefix_classes`` derives the longest-common-prefix values of
neighbouring suffixes by increasing value: a breadth-first backward extension
of suffix intervals on the transform, where level l closes the boundaries with
value l.  It stops at the threshold; boundaries still open then join suffixes
that share at least that many bytes.
"""

from __future__ import annotations

import numpy as np

from strata.llm.textops import ramp


def suffix_order(t: np.ndarray, tail: np.ndarray, longest: int) -> np.ndarray:
    """Suffix array of fragments that each end in byte 0 (``tail``: distance to that end).

    Ends differ from one another and sort by position, so no order is decided
    beyond a fragment's end.
    """
    n = len(t)
    place = max(n, 1).bit_length()             # bits of a position, below the key: one sort of values
    each = max(int(t.max(initial=1)).bit_length(), 1)
    width = max((64 - place) // each, 1)
    wide = np.zeros(n + width, np.uint64)
    wide[:n] = t
    key = np.zeros(n, np.uint64)
    alive = np.ones(n, bool)
    for j in range(width):
        part = wide[j:n + j]
        key = (key << np.uint64(each)) | np.where(alive, part, np.uint64(0))
        alive &= part > 0
    step, at, low = width, np.arange(n, dtype=np.uint64), np.uint64((1 << place) - 1)
    while True:
        if int(key.max(initial=0)) >> (64 - place):
            order = np.argsort(key, kind="stable")
            k = key[order]
        else:
            k = np.sort((key << np.uint64(place)) | at)
            order = (k & low).astype(np.int64)
            k >>= np.uint64(place)
        if step > longest:
            return order
        new = np.concatenate([[False], k[1:] != k[:-1]])
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(new).astype(np.uint64)
        nxt = np.zeros(n, np.uint64)
        far = np.flatnonzero(tail >= step)
        nxt[far] = rank[far + step] + np.uint64(1)
        key = rank * np.uint64(n + 1) + nxt
        step *= 2


def _extend(lb: np.ndarray, rb: np.ndarray, bwt: np.ndarray, lf: np.ndarray):
    """All intervals one byte to the left of the intervals [lb, rb)."""
    sizes = rb - lb
    rows = ramp(lb, sizes)
    owner = np.repeat(np.arange(len(lb)), sizes)
    ch = bwt[rows]
    real = ch > 0                              # the end of a fragment extends nothing
    rows, owner, ch = rows[real], owner[real], ch[real]
    order = np.argsort(ch, kind="stable")      # rows ascend, so their targets do
    to, owner, ch = lf[rows[order]], owner[order], ch[order]
    if not len(to):
        return to, to
    new = np.ones(len(to), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (ch[1:] != ch[:-1])
    first = np.flatnonzero(new)
    return to[first], to[np.append(first[1:], len(to)) - 1] + 1


def long_prefix_classes(t: np.ndarray, tail: np.ndarray, longest: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix order, class of each): two suffixes are in one class when they share ``least`` bytes."""
    n = len(t)
    sa = suffix_order(t, tail, longest)
    bwt = t[sa - 1]
    lf = np.empty(n, np.int64)
    lf[np.argsort(bwt, kind="stable")] = np.arange(n)
    open_ = np.ones(n + 1, bool)               # boundary before suffix k has no value yet
    open_[[0, n]] = False
    ends = int((t == 0).sum())
    at = np.concatenate([np.arange(ends), ends + np.concatenate([[0], np.cumsum(np.bincount(t)[1:])])])
    lb, rb = at[:-1], at[1:]
    lb, rb = lb[rb > lb], rb[rb > lb]
    open_[lb] = False                          # value 0
    for _ in range(1, least):
        lb, rb = _extend(lb, rb, bwt, lf)
        fresh = open_[rb]
        lb, rb = lb[fresh], rb[fresh]
        if not len(rb):
            break
        open_[rb] = False
    return sa, np.cumsum(~open_[:n])
