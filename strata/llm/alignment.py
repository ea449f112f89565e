"""Alignment of two tokenizers over the same texts.

Each text is encoded by tokenizer A (byte-level BPE, ``tokenizers``; the text
with a space before it) and by tokenizer B (``sentencepiece``, which adds that
space).  Both report character spans.  Where a token's span ends and its
successor's begins at the same character, the cut is clean and its byte offset
is that of the character; where spans overlap or repeat (a multibyte character
in several tokens, byte-fallback pieces, a space that only one side shows), the
offset is refined by the decoded bytes of the tokens.  Byte offsets where tokens
of both sides end split the text into groups; tokens of one group are linked.

The installed ``sentencepiece`` no longer has the immutable proto; the spans come
from its ``offset_mapping``, which holds the same numbers.

Neither tokenizer has a token that goes on over a space after another character
(``Pair`` checks that in the vocabulary files), so such a place always ends a group
and the runs between them, mostly words, are encoded and aligned by themselves.  A
worker keeps the alignment of the runs it met; a text is the sum of its runs.
Files that fail the check are encoded text by text.

Documents are packed into blocks of about ``BLOCK_BYTES`` of text; a block's
rows carry its distinct (A id, B id) pairs once, with the links of its distinct runs
and each document's runs, all packed.
A pair's count is the number of documents that hold it linked; counts are summed
by Spark from one entry per block and pair, and come back to the blocks packed
(see ``lookups``).  Texts are never cut but at the places above; a run without such a
place is encoded whole, which takes some 60 times its bytes in its task.

Defined cases: null and empty texts, and texts whose joined token bytes on either
side differ from space + text (U+2581 in the text, characters that a side
normalises or does not know) have no tokens: zeros and an empty group text.
Null and repeated doc_ids are documents of their own; ties for an A id's
highest count all count as best; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.blocks import cuts, limit_batches, stored, texts
from strata.llm.lookups import ASK_SCHEMA, Shape, answers, ask, ask_table, received
from strata.llm.textops import column_bytes, column_ids, group_starts, ids_out, ramp

BLOCK_BYTES = 1 << 20
SLICE_CHARS = 1 << 16            # characters encoded at a time, or one longer run
KNOWN_CHARS = 3 << 22            # characters of runs whose alignment a worker keeps
RUNS = re.compile(r" *[^ ]+(?: +\Z)?| +")
INSIDE = re.compile("[^▁]▁")
STATS = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED_SCHEMA = ("block long, n_keys long, ids binary, stats binary, groups binary, keys binary, held binary, "
                  "width binary, at binary, times binary, doc binary, run binary, n binary")


def byte_alphabet() -> dict[str, int]:
    """Characters of byte-level BPE entries: visible Latin-1 stands for itself,
    the other bytes for the code points from 256 on, in order."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(rest)}


class Entries:
    """Bytes of every token id: ``size[id]`` bytes from ``start[id]`` in ``data``."""

    def __init__(self, by_id: list[bytes]):
        self.size = np.array([len(x) for x in by_id], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)])[:-1]
        self.data = np.frombuffer(b"".join(by_id), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ramp(self.start[ids], self.size[ids])]


class Runs:
    """Aligned runs by number: token and group numbers, group texts, and links (run i holds the
    ``width[i]`` distinct id pairs from ``first[i]``, ``times`` links of each)."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.groups: list[str] = []
        self._whole: tuple | None = None

    def add(self, numbers: np.ndarray, groups: list[str], width: np.ndarray, keys: np.ndarray, times: np.ndarray) -> None:
        """``numbers``: n_a, n_b and n_groups of every run; n_a = -1 where bytes differ."""
        self.parts.append((numbers, width, keys, times))
        self.groups += groups
        self._whole = None

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """numbers, first, width, keys, times of all runs."""
        if self._whole is None:
            self.parts = [tuple(np.concatenate(x) for x in zip(*self.parts))]
            numbers, width, keys, times = self.parts[0]
            self._whole = numbers, np.cumsum(width) - width, width, keys, times
        return self._whole

    def mark(self) -> tuple:
        """The present state, for ``cut``."""
        self.arrays()
        return len(self.groups), list(self.parts)

    def cut(self, many: int, parts: list[tuple]) -> None:
        """Back to a state that ``mark`` gave."""
        del self.groups[many:]
        self.parts, self._whole = list(parts), None


class Pair:
    """The two loaded tokenizers of a Python worker, and the runs that it has aligned."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        spell = byte_alphabet()
        spec = json.load(open(a_path, encoding="utf-8"))
        by_id = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for entry, i in spec["model"]["vocab"].items():
            by_id[i] = bytes(spell[c] for c in entry) if all(c in spell for c in entry) else entry.encode()
        self.a_bytes = Entries(by_id)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = Entries([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                                for i, p in enumerate(pieces)])
        self.split = _splits(spec) and not any(INSIDE.search(p) for p in pieces)
        self.known: dict[str, int] = {}
        self.table, self.held = Runs(), 0
        self.table.add(*_no_links([(-1, 0, 0)]))          # number 0: runs whose bytes differ
        self.kept: tuple | None = None
        self.passing: list[str] = []

    def runs(self, text: str) -> list[str]:
        """Space + text cut before every space that stands between two other characters' runs."""
        return RUNS.findall(" " + text) if self.split else [" " + text]

    def learn(self, runs: set[str]) -> None:
        """Align the runs of a block that are not known yet.

        Runs are kept until they fill ``KNOWN_CHARS``; later ones, the rare ones by
        then, are kept for their block only.
        """
        if self.kept:
            self.table.cut(*self.kept)
            for r in self.passing:
                del self.known[r]
        elif self.held > KNOWN_CHARS:
            self.kept = self.table.mark()
        new = [r for r in runs if r not in self.known]
        plain = [r for r in new if self.split and r[-1] != " " and "▁" not in r]
        for lo, hi in cuts(np.array([len(r) for r in plain], np.int64), SLICE_CHARS):
            self._learn(plain[lo:hi])
        for r in new:                                     # a run that ends the text with spaces, or has the piece mark
            if r not in self.known:
                self._learn([r])
        self.held += sum(map(len, new)) + 64 * len(new)
        self.passing = new if self.kept else []

    def _learn(self, runs: list[str]) -> None:
        """Align runs in one go: side by side they are encoded as they are alone."""
        text = "".join(runs)[1:]
        (left,), (right,) = self.encode([text])
        found = aligned_text(self, text, left, right)
        if found is None:
            if len(runs) == 1:
                self.known[runs[0]] = 0
            else:
                for r in runs:
                    self._learn([r])
            return
        base = len(self.table.groups)
        self.table.add(*_run_links(found, np.array([len(r.encode()) for r in runs], np.int64)))
        self.known.update(zip(runs, range(base, base + len(runs))))

    def encode(self, slice_: list[str]) -> tuple[list, list]:
        """Per text the (ids, span begins, span ends) of A and B over space + text, in characters."""
        left = []
        for e in self.a.encode_batch([" " + t for t in slice_], add_special_tokens=False):
            span = np.array(e.offsets, np.int64).reshape(-1, 2)
            left.append((np.array(e.ids, np.int64), span[:, 0], span[:, 1]))
        right = []
        for m in self.b.encode(slice_, return_type="offset_mapping", num_threads=1):
            span = np.array(m["offsets"], np.int64).reshape(-1, 2) + 1
            if len(span):
                span[0, 0] = 0               # the first piece also has the added space
            right.append((np.array(m["ids"], np.int64), span[:, 0], span[:, 1]))
        return left, right


def _splits(spec: dict) -> bool:
    """Whether A treats every run by itself: its byte-level pattern never goes on over a
    space after another character, and nothing rewrites the text before it."""
    pre = spec.get("pre_tokenizer") or {}
    return (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and spec.get("normalizer") is None and spec["model"]["type"] == "BPE")


@lru_cache(maxsize=1)
def loaded(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


def byte_ends(side: tuple, entries: Entries, offset: np.ndarray) -> np.ndarray:
    """Byte offset of every token's end.  ``offset``: byte offset of every character.

    Clean cuts between spans give it directly; between two of them the decoded
    bytes are added up from the last one.
    """
    ids, begin, end = side
    clean = np.ones(len(ids), bool)
    clean[:-1] = (end[:-1] == begin[1:]) & (end[:-1] > begin[:-1]) & (end[1:] > begin[1:])
    size = np.cumsum(entries.size[ids])
    at = offset[np.minimum(end, len(offset) - 1)]
    # drift of the decoded bytes against the last clean cut, carried over the tokens up to the next one
    drift = np.where(clean, at - size, 0)
    last = np.maximum.accumulate(np.where(clean, np.arange(len(ids)), -1))
    return size + np.where(last >= 0, drift[last], 0)


class Aligned(NamedTuple):
    """Tokens of a text on both sides with their groups, and where groups end in bytes."""

    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    ends: np.ndarray


def aligned_text(pair: Pair, text: str, left: tuple, right: tuple) -> Aligned | None:
    """Groups of space + text, or None where a side's joined bytes differ from it."""
    body = np.frombuffer(b" " + text.encode(), np.uint8)
    for side, entries in ((left, pair.a_bytes), (right, pair.b_bytes)):
        if int(entries.size[side[0]].sum()) != len(body) or not np.array_equal(entries.joined(side[0]), body):
            return None
    offset = np.append(np.flatnonzero((body & 0xC0) != 0x80), len(body))
    ea, eb = byte_ends(left, pair.a_bytes, offset), byte_ends(right, pair.b_bytes, offset)
    near = np.minimum(np.searchsorted(eb, ea), len(eb) - 1)
    common = ea[(eb[near] == ea) & (np.diff(ea, append=-1) != 0)]
    return Aligned(left[0], right[0], np.searchsorted(common, ea), np.searchsorted(common, eb), common)


def group_texts(x: Aligned) -> list[str]:
    """``a1,a2|b1`` of every group."""
    a, b, n = list(map(str, x.a.tolist())), list(map(str, x.b.tolist())), len(x.ends)
    ca, cb = (np.searchsorted(g, np.arange(n + 1)).tolist() for g in (x.group_a, x.group_b))
    return [",".join(a[i:j]) + "|" + ",".join(b[k:m]) for i, j, k, m in zip(ca, ca[1:], cb, cb[1:])]


def _tallied(ids: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, id) in order of the group, with their numbers."""
    key, n = np.unique(group << 32 | ids, return_counts=True)
    return key & 0xFFFFFFFF, key >> 32, n


def _run_links(x: Aligned, sizes: np.ndarray) -> tuple:
    """Arguments of ``Runs.add`` for runs of ``sizes`` bytes that lie side by side in the text.

    Equal ids of a group are tallied first, so a group costs its distinct ids of
    A times those of B, not its tokens.
    """
    run = np.searchsorted(np.cumsum(sizes), x.ends)                   # run of every group
    many = len(sizes)
    numbers = np.stack([np.bincount(run[x.group_a], minlength=many), np.bincount(run[x.group_b], minlength=many),
                        np.bincount(run, minlength=many)], axis=1).astype(np.int64)
    texts_ = group_texts(x)
    edge = np.searchsorted(run, np.arange(many + 1)).tolist()
    a, ga, na = _tallied(x.a, x.group_a)
    b, gb, nb = _tallied(x.b, x.group_b)
    first = np.searchsorted(gb, np.arange(len(x.ends) + 1))
    width = np.diff(first)[ga]
    at = ramp(first[ga], width)
    key, of, n = np.repeat(a, width) << 32 | b[at], np.repeat(run[ga], width), np.repeat(na, width) * nb[at]
    order = np.lexsort((key, of))
    key, of, n = key[order], of[order], n[order]
    one = group_starts(of, key)
    return (numbers, [";".join(texts_[i:j]) for i, j in zip(edge, edge[1:])], np.bincount(of[one], minlength=many),
            key[one], np.add.reduceat(n, one) if len(one) else n)


def _no_links(numbers: list[tuple]) -> tuple:
    none = np.zeros(0, np.int64)
    return np.array(numbers, np.int64), [""] * len(numbers), np.zeros(len(numbers), np.int64), none, none


def _packed(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def _unpacked(cell: pa.Scalar, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(cell.as_py()), dtype)


def _block(pair: Pair, number: int, ids: np.ndarray, data: np.ndarray, offs: np.ndarray) -> tuple:
    raw = data.tobytes()
    texts_ = [raw[lo:hi].decode() for lo, hi in zip(offs[:-1].tolist(), offs[1:].tolist())]
    runs = [pair.runs(t) if t else [] for t in texts_]
    pair.learn(set().union(*runs))
    numbers, first, width, keys, times = pair.table.arrays()
    at = [[pair.known[r] for r in own] for own in runs]
    at = [own if all(own) else [] for own in at]              # one run whose bytes differ voids its text
    groups = pair.table.groups
    digests = [hashlib.sha256(";".join([groups[i] for i in own]).encode()).hexdigest() if own else "" for own in at]
    # distinct (document, run), the block's distinct runs and their links
    doc = np.repeat(np.arange(len(at)), [len(own) for own in at])
    pairs, n = np.unique(doc << 32 | np.array([i for own in at for i in own], np.int64), return_counts=True)
    doc = pairs >> 32
    used, run = np.unique(pairs & 0xFFFFFFFF, return_inverse=True)
    link = ramp(first[used], width[used])
    distinct, key = np.unique(keys[link], return_inverse=True)
    start = np.cumsum(width[used]) - width[used]
    held = np.sort(np.repeat(doc, width[used][run]) << 32 | key[ramp(start[run], width[used][run])])
    held = held[np.diff(held, prepend=-1) != 0]
    stats = np.zeros((len(at), 4), np.int64)
    own = np.concatenate([numbers[used], np.zeros((len(used), 1), np.int64)], axis=1)
    np.add.at(own[:, 3], np.repeat(np.arange(len(used)), width[used]), times[link])
    np.add.at(stats, doc, own[run] * n[:, None])
    return (number, len(distinct), _packed(ids), _packed(stats), "\n".join(digests).encode(), _packed(distinct),
            _packed(np.bincount(held & 0xFFFFFFFF, minlength=len(distinct)).astype(np.int64)),
            _packed(width[used].astype(np.int32)), _packed(key.astype(np.int32)), _packed(times[link].astype(np.int32)),
            _packed(doc.astype(np.int32)), _packed(run.astype(np.int32)), _packed(n.astype(np.int32)))


_ALIGNED = [pa.int64(), pa.int64(), *[pa.binary()] * 11]
_NAMES = [c.split()[0] for c in ALIGNED_SCHEMA.split(", ")]


def _align(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = loaded(a_path, b_path)
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            data, offs = column_bytes(batch.column("text"))
            ids = column_ids(batch.column("doc_id"))
            for lo, hi in cuts(np.diff(offs), BLOCK_BYTES):
                row = _block(pair, number, ids[lo:hi], data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, _ALIGNED)], _NAMES)
                number += 1
    return run


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield pa.RecordBatch.from_arrays([pa.array(_unpacked(batch.column(c)[i], np.int64)) for c in ("keys", "held")],
                                             ["key", "docs"])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """key (A id << 32 | B id), docs (documents that hold it linked), best (1 where
    docs is the highest of the A id); an A id has at most as many rows as B has ids."""
    counts = stored(aligned.select("keys", "held").mapInArrow(_held, "key long, docs long")
                    .groupBy("key").agg(F.sum("docs").alias("docs")), "align-counts")
    a = F.shiftright("key", 32)
    top = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("top"))
    return stored(counts.withColumn("a", a).join(top, "a")
                  .select("key", "docs", (F.col("docs") == F.col("top")).cast("long").alias("best")), "align-pairs")


def _asks(shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = list(ask(shape, batch.column("block")[i].as_py(), _unpacked(batch.column("keys")[i], np.int64)))
                yield from ask_table(rows).to_batches()
    return run


OUT_SCHEMA = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
              "groups_sha256 string")


def _totals(shape: Shape):
    def run(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        for i in range(blocks.num_rows):
            cell = {c: blocks.column(c)[i] for c in _NAMES}
            keys = _unpacked(cell["keys"], np.int64)
            width, at, times, doc, run, n = (_unpacked(cell[c], np.int32).astype(np.int64)
                                             for c in ("width", "at", "times", "doc", "run", "n"))
            docs, best = received(shape, keys, replies, 2)
            stats = _unpacked(cell["stats"], np.int64).reshape(-1, len(STATS))
            of = np.repeat(np.arange(len(width)), width)

            def total(number):
                """Sum over a document's links of the numbers of their pairs."""
                per_run, sums = np.zeros(len(width), np.int64), np.zeros(len(stats), np.int64)
                np.add.at(per_run, of, times * number[at])
                np.add.at(sums, doc, n * per_run[run])
                return pa.array(sums)
            out.append(pa.table([ids_out(_unpacked(cell["ids"], np.int64)), *[pa.array(x) for x in stats.T],
                                 total(best), total(docs), pa.array(cell["groups"].as_py().decode().split("\n"))],
                                [c.split()[0] for c in OUT_SCHEMA.split(", ")]))
        return pa.concat_tables(out) if out else EMPTY
    EMPTY = pa.table([pa.array([], pa.string() if "string" in c else pa.int64()) for c in OUT_SCHEMA.split(", ")],
                     [c.split()[0] for c in OUT_SCHEMA.split(", ")])
    return run


def align(docs: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, DataFrame]:
    """(aligned blocks, counts of all linked id pairs), both stored."""
    limit_batches(docs.sparkSession)
    aligned = stored(texts(docs).mapInArrow(_align(a_path, b_path), ALIGNED_SCHEMA), "aligned")
    return aligned, pair_counts(aligned)


def alignment(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Token and link numbers of every document (OUT_SCHEMA)."""
    aligned, pairs = align(docs, a_path, b_path)
    asked = aligned.agg(F.sum("n_keys")).head()[0] or 0
    shape = Shape(pairs.count(), asked)
    asks = aligned.select("block", "keys").mapInArrow(_asks(shape), ASK_SCHEMA)
    replies = stored(answers(shape, asks, pairs, ["docs", "best"]), "align-replies")
    return (aligned.groupBy("block").cogroup(replies.groupBy("block"))
            .applyInArrow(_totals(shape), OUT_SCHEMA))
