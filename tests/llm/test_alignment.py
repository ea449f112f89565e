"""Tokenizer alignment against a plain version that walks the token bytes."""

import hashlib
import json
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from strata.llm import lookups
from strata.llm.alignment import OUT_SCHEMA, Pair, align, aligned_text, alignment, byte_alphabet, byte_ends
from strata.llm.queries import tokenizer_files

SCHEMA = "doc_id long, text string, block string, key int, keys int, at string, salt int"
ROWS = [(1, "The quick brown fox jumps."), (2, "The quick brown fox jumps."), (None, "null id: the fox"), (None, None),
        (3, None), (4, ""), (5, " "), (6, "  two  spaces\n\n\tand tabs "), (7, "naïve café — 漢字仮名 👩‍👩‍👧 ž\x00z"),
        (8, "a▁b"), (9, "<s> </s> <unk> <0x41> <|endoftext|>"), (10, "ﬁ ﻿x é"), (11, "aaaaaaaaaa" * 400),
        (12, "fox " * 3000), (14, "end "), (15, "end  \n"), (16, "x  y   "), (17, "two words ▁"), (18, "words again"), (13, "".join(chr(0x4E00 + 7 * i) for i in range(900))), (1, "repeated id, other text")]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, 2, "y", 3) for d, t in rows], SCHEMA)


def plain(rows):
    """Rows of OUT_SCHEMA by walking both token lists with dictionaries."""
    a_path, b_path = tokenizer_files()
    a, b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    a.encode_special_tokens = True
    spell = byte_alphabet()
    entry = {i: bytes(spell[c] for c in e) for e, i in json.load(open(a_path))["model"]["vocab"].items()
             if e != "<|endoftext|>"}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    docs, counts = [], Counter()
    for d, t in rows:
        x = [(i, entry[i]) for i in a.encode(" " + (t or ""), add_special_tokens=False).ids]
        y = [(i, piece(i)) for i in b.encode(t or "")]
        whole = (" " + (t or "")).encode()
        groups, link = [], Counter()
        if t and b"".join(s for _, s in x) == whole == b"".join(s for _, s in y):
            left, right, done = [], [], [0, 0]
            while x or y:
                side = 0 if done[0] <= done[1] else 1
                i, s = (x, y)[side].pop(0)
                (left, right)[side].append(i)
                done[side] += len(s)
                if done[0] == done[1]:
                    groups.append((left, right))
                    link.update((u, v) for u in left for v in right)
                    left, right = [], []
        docs.append((d, groups, link))
        counts.update(link.keys())
    top = defaultdict(int)
    for (u, _), n in counts.items():
        top[u] = max(top[u], n)
    for d, groups, link in docs:
        text = ";".join(",".join(map(str, u)) + "|" + ",".join(map(str, v)) for u, v in groups)
        yield (d, sum(len(u) for u, _ in groups), sum(len(v) for _, v in groups), len(groups), sum(link.values()),
               sum(n for k, n in link.items() if counts[k] == top[k[0]]), sum(n * counts[k] for k, n in link.items()),
               hashlib.sha256(text.encode()).hexdigest() if groups else "")


def test_alignment(spark):
    got = Counter(map(tuple, alignment(frame(spark, ROWS), *tokenizer_files()).collect()))
    assert got == Counter(plain(ROWS))


def test_many_buckets_and_salts(spark, monkeypatch):
    monkeypatch.setattr(lookups, "TABLE_KEYS", 64)
    monkeypatch.setattr(lookups, "ASKED_KEYS", 16)
    docs = frame(spark, ROWS).repartition(6)
    assert Counter(map(tuple, alignment(docs, *tokenizer_files()).collect())) == Counter(plain(ROWS))


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert Counter(map(tuple, alignment(docs, *tokenizer_files()).collect())) == Counter(plain(rows))


def test_empty_table(spark):
    got = alignment(frame(spark, []), *tokenizer_files())
    assert got.collect() == [] and [f"{n} {t.replace('bigint', 'long')}" for n, t in got.dtypes] == OUT_SCHEMA.split(", ")


def test_pair_counts_are_documents(spark):
    _, pairs = align(frame(spark, ROWS[:2]), *tokenizer_files())
    assert {r.docs for r in pairs.collect()} == {2}


@pytest.mark.parametrize("known,slice_", [(1 << 24, 1 << 18), (50, 8)])
def test_runs_side_by_side_are_encoded_as_alone(spark, monkeypatch, known, slice_):
    from strata.llm import alignment as module

    monkeypatch.setattr(module, "KNOWN_CHARS", known)
    monkeypatch.setattr(module, "SLICE_CHARS", slice_)
    pair = Pair(*tokenizer_files())
    rows = [(i, t) for i, (_, t) in enumerate(ROWS)]
    want = {r[0]: r[1:5] + r[7:] for r in plain(rows)}
    for i, t in rows:                                    # a block of its own each: the table of runs is begun anew
        data = np.frombuffer((t or "").encode(), np.uint8)
        row = module._block(pair, 0, np.array([i]), data, np.array([0, len(data)]))
        stats = np.frombuffer(module.zstandard.ZstdDecompressor().decompress(row[3]), np.int64)
        assert (*stats.tolist(), row[4].decode()) == want[i]


@pytest.mark.parametrize("text", ["ab 👩‍👩‍👧 ž", "naïve", "\x00\x01", "漢字"])
def test_spans_are_refined_to_bytes(text):
    pair = Pair(*tokenizer_files())
    left, right = (side[0] for side in pair.encode([text]))
    body = (" " + text).encode()
    offset = np.append([i for i, c in enumerate(body) if c & 0xC0 != 0x80], len(body))
    for side, entries in ((left, pair.a_bytes), (right, pair.b_bytes)):
        assert byte_ends(side, entries, offset).tolist() == np.cumsum(entries.size[side[0]]).tolist()
    assert len(aligned_text(pair, text, left, right).ends) >= 1
