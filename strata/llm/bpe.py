"""BPE encoding and decoding with a given vocabulary of merges.

Encoder: an Aho-Corasick pass over a word gives the longest token at every
place; tokens are taken left to right, and a token that does not fit the one
before it gives way to its next shorter prefix, or the encoder steps back.  Two
tokens fit when merging their bytes in merge order ends in just these two
(``fits``, kept in a pair table); a sequence whose neighbours all fit is the
one that the merges make.  Each place fails at most once, so the work is linear
in the word.  Decoder: ids to slices of one vocabulary buffer by an offset
table.

Text handling (NFC, white space, lower case, the split into words, special
tokens, word ends) follows the vocabulary file's own settings; other kinds of
settings are refused.  Defined cases: null counts as empty and has no tokens;
every input row gives a row; extra columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.blocks import column_ids, ids_out, limit_batches, texts

#: Chunks of text whose encoding a worker keeps; the table is emptied when full.
CACHE = 500_000
OUT = "doc_id long, ids array<int>, decoded string"
_WHITE = regex.compile(r"\p{White_Space}+")
_ODD_SPACE = regex.compile("[\x1c-\x1f]")        # str.split() takes these for white space


def byte_letters() -> list[str]:
    """The printable letter of each byte value (byte-level vocabularies)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class Bpe:
    """One vocabulary: ``encode`` and ``decode`` on whole texts."""

    def __init__(self, spec: str):
        conf = json.loads(spec)
        model, steps = conf["model"], conf["normalizer"]["normalizers"]
        split, level = conf["pre_tokenizer"]["pretokenizers"]
        if ([s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or conf["decoder"] is not None
                or level["type"] != "ByteLevel" or level["add_prefix_space"] or level["use_regex"]
                or split["behavior"] != "Removed" or not split["invert"] or model["dropout"]):
            raise ValueError("the vocabulary file has settings that are not supported")
        self.end = model["end_of_word_suffix"]
        self.pieces = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.special = {t["content"]: t["id"] for t in conf["added_tokens"]}
        self.specials = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")")
        self._tables(model)
        self.kept: dict[str, tuple[tuple[int, ...], str]] = {}

    def _tables(self, model: dict) -> None:
        vocab, letters = model["vocab"], byte_letters()
        at = {c: b for b, c in enumerate(letters)}

        def word(token: str) -> str:
            """The token over 512 symbols: bytes, and 256 + byte for the last of a word."""
            last = token.endswith(self.end) and len(token) > len(self.end)
            body = [at[c] for c in (token[:-len(self.end)] if last else token)]
            if last:
                body[-1] += 256
            return "".join(map(chr, body))

        self.text = {i: word(t) for t, i in vocab.items() if t not in self.special}
        self.of = {t: i for i, t in self.text.items()}
        self.size = {i: len(t) for i, t in self.text.items()}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}       # pair -> (merge number, token)
        self.parts: dict[int, tuple[int, int, int]] = {}             # token -> (merge number, left, right)
        for r, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, c = vocab[left], vocab[right], vocab[left + right]
            self.rank.setdefault((a, b), (r, c))
            self.parts.setdefault(c, (r, a, b))
        self.machine = ahocorasick.Automaton()
        for t, i in self.of.items():
            self.machine.add_word(t, (len(t) - 1, i))
        self.machine.make_automaton()
        self.shorter = {i: next((self.of[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.of), None)
                        for i, t in self.text.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        names = [b""] * (max(*vocab.values(), *self.special.values()) + 1)
        for t, i in {**vocab, **self.special}.items():
            names[i] = t.encode()
        self.names = b"".join(names)                                 # the decoder's buffer and offsets
        self.offset = np.concatenate([[0], np.cumsum([len(x) for x in names])]).tolist()

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b ends in exactly (a, b).

        Looks back in time from (a, b): the latest merge of the two is undone
        again and again.  If the neighbours that then touch could merge earlier
        than what was undone, the merges would have joined them instead; of
        equal merges the left one comes first.
        """
        known = self.pairs.get((a, b))
        if known is None:
            known = self.pairs[a, b] = self._look_back(a, b)
            if len(self.pairs) > CACHE:
                self.pairs.clear()
        return known

    def _look_back(self, a: int, b: int) -> bool:
        limit = (len(self.rank), 0)                   # (merge number, 1 if it lies right of the seam)
        while True:
            if (a, b) in self.rank and (self.rank[a, b][0], 0) < limit:
                return False
            left, right = self.parts.get(a), self.parts.get(b)
            if left is None and right is None:
                return True
            if right is None or (left is not None and left[0] > right[0]):
                limit, a = (left[0], 0), left[2]
            else:
                limit, b = (right[0], 1), right[1]

    def word(self, symbols: str) -> list[int]:
        """Tokens of one word of symbols."""
        greedy = [token for _, (_, token) in self.machine.iter_long(symbols)]
        pairs = self.pairs
        for pair in zip(greedy, greedy[1:]):
            fit = pairs.get(pair)
            if not (self.fits(*pair) if fit is None else fit):
                return self._back(symbols)
        return greedy                                  # the longest tokens fit as they are

    def _back(self, symbols: str) -> list[int]:
        """Longest tokens with backtracking."""
        n, size = len(symbols), self.size
        longest = [0] * n
        for stop, (back, token) in self.machine.iter(symbols):
            longest[stop - back] = token               # a later stop is a longer token
        out: list[int] = []
        dead: set[int] = set()
        at, token = 0, longest[0]
        while at < n:
            stop = at + size[token]
            if stop not in dead and (not out or self.fits(out[-1], token)):
                out.append(token)
                at = stop
                token = longest[at] if at < n else token
            elif self.shorter[token] is not None:
                token = self.shorter[token]
            else:
                dead.add(at)
                token = out.pop()
                at -= size[token]
        return out

    def _chunk(self, chunk: str) -> tuple[tuple[int, ...], str]:
        """Ids and decoded text of a piece of text without white space."""
        clean = chunk.lower() if chunk.isascii() else (
            unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower())
        ids: list[int] = []
        for piece in self.pieces.findall(clean):
            b = piece.encode()
            ids += self.word(b[:-1].decode("latin-1") + chr(256 + b[-1]))
        return tuple(ids), self.decode(ids)

    def encode(self, text: str) -> tuple[list[int], str]:
        """(ids, decoded text) of a whole text."""
        ids: list[int] = []
        words: list[str] = []
        kept = self.kept
        for part in self.specials.split(text) if "<|" in text else (text,):
            if part in self.special:
                ids.append(self.special[part])
                words.append(part)
                continue
            for chunk in (_WHITE.split(part) if _ODD_SPACE.search(part) else part.split()):
                found = kept.get(chunk)
                if found is None:
                    found = self._chunk(chunk)
                    if len(chunk) <= 64:
                        if len(kept) >= CACHE:
                            kept.clear()
                        kept[chunk] = found
                if found[0]:
                    ids += found[0]
                    words.append(found[1])
        return ids, " ".join(words)

    def decode(self, ids: list[int]) -> str:
        """Token names by the offset table, joined by a space."""
        o = self.offset
        return b" ".join([self.names[o[i]:o[i + 1]] for i in ids]).decode()


@lru_cache(maxsize=1)
def _bpe(spec: str) -> Bpe:
    return Bpe(spec)


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids and decoded text of every whole text.

    ``vocabulary`` is the path of a tokenizer file on the driver; its contents
    (a few MB, independent of the data) go to the tasks.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())

    def run(batches):
        bpe = _bpe(spec.value)
        for b in batches:
            done = [bpe.encode(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [ids_out(column_ids(b.column("doc_id"))), pa.array([x[0] for x in done], pa.list_(pa.int32())),
                 pa.array([x[1] for x in done], pa.string())], ["doc_id", "ids", "decoded"])

    limit_batches(spark, 256)
    return texts(docs).mapInArrow(run, OUT)


def digests(encoded: DataFrame) -> DataFrame:
    """Token count and digests of ids and decoded text."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
