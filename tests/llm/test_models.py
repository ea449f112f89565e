"""Index, encoder, models, ledger and rollup on small tables with awkward rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import toxicity
from strata.llm.blob_ledger import BlobLedger, find_spans, joined_spans
from strata.llm.bpe import Bpe, encode_documents
from strata.llm.folds import held_out, may_learn
from strata.llm.lookups import Shape, ask
from strata.llm.phrase_index import build_index, contamination, phrase_matches
from strata.llm.ppm_language import fit_languages, identify, keep_identified
from strata.llm.queries import op3_toxicity, op6_language, vocabulary
from strata.llm.token_rollup import TokenRollup, changes
from strata.llm.toxicity import fit_toxicity, score_toxicity
from strata.session import scratch_path
from tests.conftest import SF_CHECK

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def test_contamination(spark):
    r = random.Random(3)
    vocab = [f"v{i}" for i in range(30)] + ["é", "ß1"]
    item = [" ".join(r.choice(vocab) for _ in range(n)) for n in (20, 13, 5, 1, 30)]
    docs = [(None, item[0]), (1, None), (2, ""), (3, "... !"), (4, item[4].upper().replace(" ", "-")), (4, "v1")]
    for i in range(5, 40):
        t = " ".join(r.choice(vocab) for _ in range(r.randint(1, 90)))
        docs.append((i, t + " " + r.choice(item) + " " + t if i % 2 else t))
    items = [(7, item[0]), (8, item[1]), (10, item[2]), (None, item[3]), (9, item[4]), (9, item[4]), (11, None), (12, "")]
    got = Counter((x.doc_id, x.n_words, x.n_hit, tuple(x["items"]), x.contaminated) for x in contamination(
        spark.createDataFrame([(d, t, "s", 1) for d, t in docs], "doc_id long, text string, term string, shard int"),
        spark.createDataFrame([(i, t, "p") for i, t in items], "item_id long, text string, phrase string")).collect())
    want = Counter()
    for d, t in docs:
        w, hit, named = words(t), set(), set()
        for i, x in items:
            v = words(x)
            n = min(13, len(v))
            for k in range(len(v) - n + 1 if v else 0):
                for j in range(len(w) - n + 1):
                    if w[j:j + n] == v[k:k + n]:
                        hit.update(range(j, j + n))
                        named.add("" if i is None else str(i))
        want[d, len(w), len(hit), tuple(sorted(named)), bool(hit) and 20 * len(hit) >= len(w)] += 1
    assert got == want


def test_proximity_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b x c d"), (2, "a b c d"), (3, "d c b a")], "doc_id long, text string")
    phrase = spark.createDataFrame([(5, b"b c d")], "phrase_id long, phrase binary")
    index = build_index(docs)
    assert [x.doc_id for x in phrase_matches(index, phrase).collect()] == [2]
    assert sorted({x.doc_id for x in phrase_matches(index, phrase, slop=1).collect()}) == [1, 2]
    none = spark.createDataFrame([], "item_id long, text string")
    assert [x.n_hit for x in contamination(docs, none).collect()] == [0, 0, 0]
    assert contamination(docs.limit(0), none).collect() == []


def test_encoder_equals_library(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(vocabulary())
    r = random.Random(1)
    letters = "abcdeABÉéßΣς'’ \t\n\x1c  中문0½²<|>endoftext!.,İ́​　😀"
    texts = ["", "a<|endoftext|>b <|startoftext|>", "it's he'll 'S"] + [
        "".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(1500)] + [
        "".join(r.choice("aeionrstlh") for _ in range(r.randint(1, 300))) for _ in range(300)]
    own = Bpe(open(vocabulary(), encoding="utf-8").read())
    for text in texts:
        want = lib.encode(text, add_special_tokens=False).ids
        ids, decoded = own.encode(text)
        assert ids == want and decoded == lib.decode(want, skip_special_tokens=False), repr(text)
    docs = spark.createDataFrame([(None, None, "x"), (1, "Hello", "y")], "doc_id long, text string, ids string")
    got = {x.doc_id: (x.ids, x.decoded) for x in encode_documents(docs, vocabulary()).collect()}
    assert got == {None: ([], ""), 1: own.encode("Hello")}


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    got = op6_language(spark, SF_CHECK).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.98
    assert all(held == (zlib.crc32(str(d).encode()) % 3 == 1)
               for d, held in docs.select("doc_id", held_out()).collect())


def test_language_cases(spark):
    docs = spark.createDataFrame([(2, "the cat and the dog", "en", 1.0), (4, "der Hund und die Katze", "de", 1.0),
                                  (None, "the dog", None, None), (6, None, "en", None), (7, "123 !", None, None),
                                  (8, "", "de", None)], "doc_id long, text string, lang string, score double")
    trees = fit_languages(docs)
    got = {x.doc_id: x.lang_pred for x in identify(docs, trees).collect()}
    assert got == {2: "en", 4: "de", None: "en", 6: "und", 7: "und", 8: "und"}
    assert {x.doc_id for x in keep_identified(docs, trees).collect()} == {2, 4, None}
    assert {x.lang_pred for x in identify(docs, None).collect()} == {"und"}
    assert fit_languages(docs.limit(0)) is None and identify(docs.limit(0), trees).collect() == []


def test_language_trees_are_probabilities(spark):
    """The shares of all next symbols add up to one at most in every context."""
    import numpy as np

    docs = spark.createDataFrame([(2, "abracadabra", "x"), (3, "banana", "y")], "doc_id long, text string, lang string")
    trees = fit_languages(docs)
    for context in [b"abr", b"ban", b"ana", b"xbr", b"zzz", b"   ", bytes([200, 97, 98])]:
        gram = (int.from_bytes(context, "big") << 8) + np.arange(256)
        for order in (3, 2, 1, 0):
            shares = np.exp2(-trees._bits(gram, order).astype(float)).sum(0)
            assert (shares <= 1 + 1e-4).all() and (shares > 0).all()


def test_toxicity_cases(spark):
    docs = spark.createDataFrame([(i, ("you vile troll " if i % 2 else "a fine day ") * 3 + f"word{i % 7} more")
                                  for i in range(400)] + [(None, None), (900, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(400)] + [(5, None, 0)],
                                   "doc_id long, toxic int, text int")
    model = fit_toxicity(docs, labels)
    got = {x.doc_id: x.score for x in score_toxicity(docs, model).collect()}
    assert len(got) == 402 and all(0 <= s <= 1 for s in got.values())
    assert all((got[i] >= 0.7) == (i % 2 == 1) for i in range(400))
    assert fit_toxicity(docs, labels.filter("toxic = 0")) is None
    assert {x.score for x in score_toxicity(docs, None).collect()} == {0.0}
    assert score_toxicity(docs.limit(0), model).collect() == []


def test_toxicity_query(spark):
    got = op3_toxicity(spark, SF_CHECK).toPandas()
    assert len(got) == spark.read.parquet(f"{SF_CHECK}/documents.parquet").count()
    assert ((got.score >= 0.7) == (got.predicted == 1)).all()


def plain_toxicity(rows, curve_rows):
    """Score of every text by dictionaries: rows are (doc_id, text, toxic or None if not learned from)."""
    D, Ds, top = 2.0, 0.75, 3
    before, c = {}, [Counter(), Counter()]
    for d, t, y in rows:
        if y is not None and d not in curve_rows:
            w = words(t)
            c[y].update(set(w))
            for v, x in zip([None] + w[:-1], w):
                before.setdefault(x, set()).add(v)
    ca = {x: len(v) for x, v in before.items()}

    def shared(x):
        return (max(ca.get(x, 0) - Ds, 0) + sum(min(n, Ds) for n in ca.values()) / (len(ca) + 1)) / sum(ca.values())

    def share(i, x):
        left = sum(min(n, D) for n in c[i].values())
        return (max(c[i].get(x, 0) - D, 0) + left * shared(x)) / sum(c[i].values())

    known = {x: math.log(share(1, x) / share(0, x)) for x in ca}
    unknown = math.log(share(1, None) / share(0, None))
    for i in (0, 1):                                     # both models are distributions over the words and the unknown one
        assert abs(sum(share(i, x) for x in ca) + share(i, None) - 1) < 1e-9

    def value(t):
        w = words(t)
        best = sorted((max(known.get(x, unknown), unknown) for x in w), reverse=True)[:top]
        return sum(best) / len(best) if best else unknown
    return value


def toxic_rows(n=900, seed=7):
    r = random.Random(seed)
    bad, plain = [f"bad{i}" for i in range(12)], [f"word{i}" for i in range(300)]
    out = []
    for i in range(n):
        y = int(i % 6 == 0)
        w = [r.choice(plain) for _ in range(r.randint(1, 60))] + [r.choice(bad) for _ in range(r.randint(1, 5) if y else r.random() < 0.05)]
        r.shuffle(w)
        out.append((i, " ".join(w).upper() if i % 7 == 0 else " ".join(w), y))
    return out


def learned(spark, rows):
    """(rows that are learned from, ids of the curve's rows), by the operator's rules."""
    docs = spark.createDataFrame([(d, t, "s", 1) for d, t, _ in rows], "doc_id long, text string, value string, key int")
    labels = spark.createDataFrame([(d, y, 9) for d, _, y in rows], "doc_id long, toxic int, text int")
    share = min(0.2, toxicity.CALIBRATION / labels.filter(may_learn()).count())
    aside = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 30)) < int((1 << 30) * share)
    learn = {x.doc_id for x in docs.filter(may_learn()).collect()}
    return docs, labels, learn, {x.doc_id for x in docs.filter(may_learn() & aside).collect()}


def test_toxicity_equals_a_dictionary_model(spark):
    rows = toxic_rows()
    docs, labels, learn, curve = learned(spark, rows)
    model = fit_toxicity(docs, labels)
    value = plain_toxicity([(d, t, y if d in learn else None) for d, t, y in rows], curve)
    more = [(5000, None), (5001, ""), (5002, "never seen words"), (5003, "BAD1 bad1 bad1 bad1"), (None, "bad2"),
            (5003, "word1"), (5004, "word1 bad3 " * 20_000)]
    asked = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = Counter((x.doc_id, round(x.value, 4), x.n) for x in toxicity.values(
        asked.withColumn("tag", F.lit(None).cast("int")), model).collect())
    assert got == Counter((d, round(value(t), 4), len(words(t))) for d, t in [r[:2] for r in rows] + more)


def plain_mean(rows, curve_rows):
    """log P1 - log P0 per word over all words of a text, by dictionaries, as in ``plain_toxicity``."""
    D, Ds = 2.0, 0.75
    before, c = {}, [Counter(), Counter()]
    for d, t, y in rows:
        if y is not None and d not in curve_rows:
            w = words(t)
            c[y].update(set(w))
            for v, x in zip([None] + w[:-1], w):
                before.setdefault(x, set()).add(v)
    ca, total = {x: len(v) for x, v in before.items()}, [sum(c[i].values()) for i in (0, 1)]
    low = sum(min(n, Ds) for n in ca.values()) / (len(ca) + 1)

    def log_share(i, x):
        left = sum(min(n, D) for n in c[i].values())
        return math.log((max(c[i].get(x, 0) - D, 0) + left * (max(ca.get(x, 0) - Ds, 0) + low) / sum(ca.values())) / total[i])

    def value(t):
        w = words(t) or [None]
        return sum(log_share(1, x) - log_share(0, x) for x in w) / len(w)
    return value


@pytest.mark.parametrize("block,piece", [(1 << 25, 1 << 20), (300, 100)])
def test_toxicity_compares_the_models_over_whole_texts(spark, monkeypatch, block, piece):
    """Every word counts, ordinary ones too, as often as it stands in the text, whatever the blocks."""
    monkeypatch.setattr(toxicity, "BLOCK", block)
    monkeypatch.setattr(toxicity, "PIECE", piece)
    rows = toxic_rows(300)
    docs, labels, learn, curve = learned(spark, rows)
    model = fit_toxicity(docs, labels)
    mean = plain_mean([(d, t, y if d in learn else None) for d, t, y in rows], curve)
    more = [(5000, None), (5001, ""), (5002, "never seen words"), (5003, "BAD1 bad1 word1"), (None, "word2 word2 word3"),
            (5003, "word1"), (5004, "word1 bad3 " * 20_000)]
    asked = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = Counter((x.doc_id, round(x["mean"], 4), x.n) for x in toxicity.values(
        asked.withColumn("tag", F.lit(None).cast("int")), model).collect())
    assert got == Counter((d, round(mean(t), 4), len(words(t))) for d, t in [r[:2] for r in rows] + more)


def test_toxicity_pairs_do_not_depend_on_pieces(monkeypatch):
    import pyarrow as pa
    import zstandard

    rows = toxic_rows(60)
    z = zstandard.ZstdCompressor()
    batch = pa.RecordBatch.from_arrays([pa.array([z.compress(t.encode()) for _, t, _ in rows], pa.binary()),
                                        pa.array([y for *_, y in rows], pa.int32())], ["body", "toxic"])
    found = []
    for piece, joined in ((1 << 20, 1 << 23), (1 << 20, 1), (300, 2000), (300, 1)):
        monkeypatch.setattr(toxicity, "PIECE", piece)
        monkeypatch.setattr(toxicity, "PAIRS_PIECE", joined)
        n = Counter()
        for b in toxicity._pairs(iter([batch.slice(0, 25), batch.slice(25)])):
            for pair, word, n0, n1 in zip(*(c.to_pylist() for c in b.columns)):
                n.update({(pair, word, 0): n0, (pair, word, 1): n1, (pair, word, 2): 0})
        found.append(dict(n))
    assert found[0] == found[1] == found[2] == found[3]
    assert sum(v for (*_, y), v in found[0].items() if y == 1) == sum(len(set(words(t))) for _, t, y in rows if y)


class OneTask:
    """Stands for Spark's task and broadcast outside a session: a filter that every word passes."""
    value = np.full(1 << 13, 255, np.uint8), 1 << 16

    @staticmethod
    def get():
        return OneTask

    @staticmethod
    def partitionId():
        return 0


def test_toxicity_memory_of_a_block(monkeypatch):
    """What a task holds for a block grows by some bytes a word, though all words have evidence (before: 88 and 89)."""
    import tracemalloc

    monkeypatch.setattr(toxicity, "TaskContext", OneTask)
    monkeypatch.setattr(toxicity, "PIECE", 1 << 16)
    r, shape = random.Random(3), Shape(1 << 20, 0)
    lines = [" ".join(f"w{r.randrange(20_000)}" for _ in range(200)) for _ in range(3000)]

    def block(rows):
        (out,) = toxicity._kept(OneTask, shape)(iter([pa.RecordBatch.from_arrays(
            [pa.array(range(i, i + 100)), pa.array(lines[i:i + 100]), pa.nulls(100, pa.int32())], ["doc_id", "text", "tag"])
            for i in range(0, rows, 100)]))
        return out

    def scored(b):
        asked = list(ask(shape, 0, toxicity._unpacked(b.column("keys")[0], np.int64)))
        replies = pa.table([[x[2] for x in asked], [x[0] for x in asked], [x[3] for x in asked]], ["block", "bucket", "numbers"])
        return lambda: toxicity._text_values(shape, 0)(pa.Table.from_batches([b]).drop_columns(["n_keys", "keys"]), replies)

    def peak(f):
        f()                                                          # tables that stay
        tracemalloc.start()
        try:
            f()
            return tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    words_more = 2000 * 200
    assert (peak(lambda: block(3000)) - peak(lambda: block(1000))) / words_more < 45
    assert (peak(scored(block(3000))) - peak(scored(block(1000)))) / words_more < 45


def test_toxicity_pairs_are_sent_in_slices(monkeypatch):
    import zstandard

    z, text = zstandard.ZstdCompressor(), " ".join(f"word{i % 700}" for i in range(3000))
    batch = pa.RecordBatch.from_arrays([pa.array([z.compress(text.encode())], pa.binary()), pa.array([1], pa.int32())],
                                       ["body", "toxic"])
    monkeypatch.setattr(toxicity, "SENT_ROWS", 64)
    sizes = [b.num_rows for b in toxicity._pairs(iter([batch]))]
    assert max(sizes) == 64 and sum(sizes) == 701                    # the first word has a pair of its own


def test_toxicity_ordinary_words_speak_for_a_text(spark):
    """The whole text's likelihoods enter the score: of texts with the same strongest words the one whose other words
    are common in ordinary texts only is the less toxic."""
    r = random.Random(4)
    kind, both, bad = [f"kind{i}" for i in range(8)], [f"both{i}" for i in range(30)], [f"bad{i}" for i in range(4)]

    def text(toxic):
        w = [r.choice(both) for _ in range(12)] + [r.choice(both if toxic else kind) for _ in range(8)]
        r.shuffle(w)
        return " ".join(w + r.sample(bad if toxic or r.random() < 0.4 else both, 3))

    docs = spark.createDataFrame([(i, text(i % 2 == 0)) for i in range(900)], "doc_id long, text string")
    model = fit_toxicity(docs, docs.select("doc_id", (F.col("doc_id") % 2 == 0).cast("int").alias("toxic")))
    pair = spark.createDataFrame([(1, "both1 both2 both3 both4 both5 bad1 bad2 bad3"),
                                  (2, "kind1 kind2 kind3 kind4 kind5 bad1 bad2 bad3")], "doc_id long, text string")
    assert len({x.value for x in toxicity.values(pair.withColumn("tag", F.lit(None).cast("int")), model).collect()}) == 1
    got = {x.doc_id: x.score for x in score_toxicity(pair, model).collect()}
    assert got[2] < 0.1 < 0.9 < got[1]


@pytest.mark.parametrize("bits,table", [(64, 4), (1 << 25, 1 << 18)])
def test_toxicity_does_not_depend_on_filter_or_buckets(spark, monkeypatch, bits, table):
    from strata.llm import lookups

    rows = toxic_rows(400)
    docs, labels, learn, curve = learned(spark, rows)
    monkeypatch.setattr(lookups, "TABLE_KEYS", table)
    monkeypatch.setattr(lookups, "ASKED_KEYS", table)
    model = fit_toxicity(docs, labels, bits)
    value = plain_toxicity([(d, t, y if d in learn else None) for d, t, y in rows], curve)
    got = toxicity.values(docs.select("doc_id", "text", F.lit(None).cast("int").alias("tag")), model).collect()
    assert {x.doc_id: round(x.value, 4) for x in got} == {d: round(value(t), 4) for d, t, _ in rows}


def test_toxicity_counts_every_labelled_row_but_the_curve_sample(spark, monkeypatch):
    rows = [(i, f"only{i} only{i}", i % 2) for i in range(600)]
    docs, labels, learn, curve = learned(spark, rows)
    seen, store = {}, toxicity.stored
    monkeypatch.setattr(toxicity, "stored", lambda df, name: seen.setdefault(name, store(df, name)))
    fit_toxicity(docs, labels)
    assert len(curve) < 0.3 * len(learn)
    assert seen["toxic-counts"].count() == len(learn - curve)          # each row has a word of its own


def test_toxicity_held_out_recall(spark):
    """Figures of the README on a small scale: held-out toxic rows caught, ordinary ones left alone."""
    got = op3_toxicity(spark, SF_CHECK).filter("held_out").join(
        spark.read.parquet(f"{SF_CHECK}/labels.parquet"), "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(x.toxic, x.predicted): x["count"] for x in got}
    assert n.get((1, 1), 0) >= 0.7 * (n.get((1, 1), 0) + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.02 * n[0, 0]


def test_toxicity_rare_expressions_held_out(spark):
    """Toxic words that few training texts hold are found in held-out texts, as rare ordinary ones pass."""
    r = random.Random(9)
    plain, rare = [f"word{i}" for i in range(40)], [[f"odd{i}" for i in range(700)], [f"bad{i}" for i in range(100)]]
    docs = spark.createDataFrame([(i, " ".join([r.choice(plain) for _ in range(20)]
                                               + [r.choice(rare[i % 8 == 0]) for _ in range(4)]))
                                  for i in range(3200)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 8 == 0).cast("int").alias("toxic"))
    got = (score_toxicity(docs, fit_toxicity(docs, labels)).filter(held_out())
           .groupBy((F.col("doc_id") % 8 == 0).alias("toxic"), (F.col("score") >= 0.7).alias("found")).count().collect())
    n = {(x.toxic, x.found): x["count"] for x in got}
    assert n.get((True, True), 0) > 0.9 * (n.get((True, True), 0) + n.get((True, False), 0))
    assert n.get((False, True), 0) < 0.01 * n[False, False]


def test_secret_rules():
    assert find_spans("a token: secret=abc123 PASSWORD = 'hunter22' x") == [("assign", 2, 22), ("assign", 23, 43)]
    assert find_spans("secret: token : abcdefgh") == []          # a short match is used up, then dropped
    assert find_spans("é AKIA" + "A" * 16 + " " + "0f" * 12) == [("access", 2, 22), ("hex", 23, 47)]
    assert find_spans("ſecret=abcdefgh") == []                    # ASCII letters only


def test_ledger_is_incremental(spark):
    docs = spark.createDataFrame([(1, "token=abcdef"), (2, "token=abcdef"), (None, None), (3, "")],
                                 "doc_id long, text string")
    more = docs.unionByName(spark.createDataFrame([(4, "token=ghijkl")], docs.schema))
    ledger = BlobLedger(spark, scratch_path(spark, "ledger-test"))
    ledger.scan(docs)
    assert ledger.read().count() == 2                              # two distinct blobs
    ledger.scan(more)
    ledger.scan(more)
    assert ledger.read().count() == 3
    got = {x.doc_id: x.s for x in ledger.findings(more).select("doc_id", joined_spans().alias("s")).collect()}
    assert got == {1: "assign:0:12", 2: "assign:0:12", 4: "assign:0:12", None: "", 3: ""}


def test_rollup_batches(spark):
    docs = spark.createDataFrame([(1, "a", "en", 5), (2, "a", None, 7), (3, "a", "en", None)],
                                 "doc_id long, source string, lang string, n long")
    r = TokenRollup(spark, scratch_path(spark, "rollup-test"))
    assert r.totals().collect() == []
    load = changes(docs, "v1", "insert", n_tokens=F.col("n"), n_chars=F.lit(1))
    assert r.commit("one", load) and not r.commit("one", load)
    r.commit("two", changes(docs, "v1", "revise", n_tokens=F.col("n") + 1, n_chars=F.lit(1),
                            old_tokens=F.col("n"), old_chars=F.lit(1)))
    r.commit("three", changes(docs.filter("doc_id = 2"), "v1", "delete", n_tokens=F.col("n") + 1, n_chars=F.lit(1)))
    load.write.mode("overwrite").parquet(f"{r.deltas}/batch=lost")  # written, never committed
    assert [tuple(x) for x in r.totals().collect()] == [("a", "en", "v1", 2, 6, 2)]
    with pytest.raises(Exception, match="unknown op"):
        r.commit("four", changes(docs, "v1", "merge"))


def test_folds(spark):
    ids = spark.createDataFrame([(None,), (1,), (2,)], "doc_id long")
    assert [x.a for x in ids.select((held_out() & may_learn()).alias("a")).collect()] == [False] * 3
