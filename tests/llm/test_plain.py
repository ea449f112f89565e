"""Secrets, languages and token counts against plain versions of a few lines."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import queries
from strata.llm.blob_ledger import BlobLedger, joined_spans
from strata.llm.ppm_language import SYMBOLS, Trees, _grams, fit_languages, identify
from strata.session import scratch_path
from tests.conftest import SF_SMALL

RULES = [("assign", re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), 1, 6),
         ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile(r"[0-9a-f]+"), 0, 24)]


def plain_spans(text):
    out = []
    for rank, (kind, pattern, group, least) in enumerate(RULES):
        out += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(text or "")
                if len(m.group(group)) >= least]
    return [s for *_, s in sorted(out)]


def secret_rows():
    r = random.Random(11)
    parts = ["api_key=", "TOKEN : ", "password='", "AKIA", "passwd", "=", "A1B2C3D4E5F6G7H8", "0123456789abcdef", "deadbeef",
             " ", "\n", "é", "😀", "secret", ":", '"', "x", "abc.def/ghi", "kEy"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 40)))) for i in range(300)]
    return rows + [(None, "token=abcdef"), (None, None), (5, "token=abcdef"), (900, ""), (901, ("x " * 200_000) + "secret=abcdefg")]


def test_secrets_equal_a_plain_version(spark):
    rows = secret_rows()
    docs = spark.createDataFrame([(d, t, "b", 1, "s") for d, t in rows],
                                 "doc_id long, text string, blob string, salt int, spans string")
    ledger = BlobLedger(spark, scratch_path(spark, "plain-ledger"))
    ledger.scan(docs)
    got = Counter((r.doc_id, r.s) for r in ledger.findings(docs).select("doc_id", joined_spans().alias("s")).collect())
    assert got == Counter((d, ",".join(plain_spans(t))) for d, t in rows)
    none = docs.limit(0)
    ledger.scan(none)
    assert ledger.findings(none).collect() == []


def test_secrets_query_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in queries.op7_secrets(spark, SF_SMALL).collect()}
    for d in docs:
        spans = plain_spans(d.text)
        count = Counter(s.split(":")[0] for s in spans)
        assert got[d.doc_id] == (count["assign"], count["access"], count["hex"],
                                 hashlib.sha256(",".join(spans).encode()).hexdigest())


def test_a_new_rule_version_scans_all_blobs_again(spark):
    docs = spark.createDataFrame([(1, "token=abcdef mail@x.org"), (2, "plain"), (3, "plain")], "doc_id long, text string")
    path = scratch_path(spark, "versions")
    first = BlobLedger(spark, path)
    first.scan(docs)
    first.scan(docs.unionByName(spark.createDataFrame([(4, "secret=ghijklm")], docs.schema)))
    assert first.read().groupBy("rules").count().collect() == [(1, 3)]
    mail = {**first.rules, "mail": (r"[a-z]+@[a-z]+[.]org", 0, 5, False)}
    with pytest.raises(ValueError):
        BlobLedger(spark, path, mail)
    second = BlobLedger(spark, path, mail, version=2)
    second.scan(docs)
    assert {tuple(r) for r in second.read().groupBy("rules").count().collect()} == {(1, 3), (2, 2)}
    spans = {r.doc_id: r.s for r in second.findings(docs).select("doc_id", joined_spans().alias("s")).collect()}
    assert spans == {1: "assign:0:12,mail:13:23", 2: "", 3: ""}
    old = {r.doc_id: r.s for r in first.findings(docs).select("doc_id", joined_spans().alias("s")).collect()}
    assert old == {1: "assign:0:12", 2: "", 3: ""}


# ---- language ------------------------------------------------------------

def plain_lengths(samples, text):
    """Code length of ``text`` per language: escape method C over contexts of three bytes down to none."""
    out = {}
    for lang, texts in samples.items():
        seen = [defaultdict(Counter) for _ in range(4)]
        for t in texts:
            raw = b"   " + t.encode().lower()
            for i in range(3, len(raw)):
                for k in range(4):
                    seen[k][raw[i - k:i]][raw[i]] += 1
        bits, raw = 0.0, b"   " + text.encode().lower()
        for i in range(3, len(raw)):
            for k in (3, 2, 1, 0):
                c = seen[k][raw[i - k:i]]
                total, kinds = sum(c.values()), len(c)
                if raw[i] in c:
                    bits += math.log2((total + kinds) / c[raw[i]])
                    break
                if total:
                    bits += math.log2((total + kinds) / kinds)
            else:
                bits += math.log2(SYMBOLS)
        out[lang] = bits
    return out


def test_code_lengths_equal_a_plain_version():
    r = random.Random(2)
    samples = {"aa": ["the cat sat on the mat"] * 3 + ["that hat"], "bb": ["der Hund und die Katze", "das ist gut"]}
    langs = sorted(samples)
    grams, lang, counts = [], [], []
    for i, k in enumerate(langs):
        raw = [t.encode() for t in samples[k]]
        gram, _ = _grams(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(x) for x in raw]))
        key, n = np.unique(gram, return_counts=True)
        grams.append(key)
        lang.append(np.full(len(key), i))
        counts.append(n)
    trees = Trees(langs, np.concatenate(lang), np.concatenate(grams), np.concatenate(counts))
    for text in ["the hat", "die Katze ist", "", "x", "THE CAT", "".join(r.choice("the dasi") for _ in range(400))]:
        raw = np.frombuffer(text.encode(), np.uint8)
        got = trees.lengths(raw, np.array([0, len(raw)]))[0]
        want = plain_lengths(samples, text)
        assert got == pytest.approx([want[k] for k in langs], rel=1e-5, abs=1e-4)


def test_language_ties_and_a_long_text(spark):
    rows = [(i, "same words in both", k) for i, k in enumerate(["b", "a"] * 6)]
    trees = fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = {r.doc_id: r.lang_pred for r in identify(spark.createDataFrame(
        [(1, "same words"), (2, "same " * 300_000)], "doc_id long, text string"), trees).collect()}
    assert got == {1: "a", 2: "a"}                        # ties go to the first language by name


# ---- token counts --------------------------------------------------------

def test_token_counts_with_clashing_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = docs.withColumns({c: F.lit(3) for c in ("size", "words", "alnums", "n_tokens", "version")})
    odd = odd.unionByName(odd.limit(1).withColumn("text", F.repeat(F.lit("long "), 200_000)))
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, queries.op8_token_counts(spark, str(tmp_path)).collect()), key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(f"SELECT source, lang, version, n_docs, n_tokens, n_chars FROM ({queries.ORACLE_SQL['op8_token_counts']})")
    assert got == sorted(want.fetchall(), key=str)
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert queries.op8_token_counts(spark, str(tmp_path / "none")).collect() == []
