"""The pipeline's decisions against a brute-force version of its stages."""

import hashlib
import re

import pytest

import corpus_pipeline
from strata import session
from strata.llm import blocks
from strata.llm import rows as rows_module
from strata.llm.folds import may_learn
from strata.llm.ppm_language import fit_languages, identify
from strata.llm.queries import vocabulary
from strata.sinks.store import Store
from tests.conftest import SF_SMALL

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def test_pipeline(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    got = {x.doc_id: tuple(x)[1:] for x in corpus_pipeline.run(spark, SF_SMALL).collect()}
    named = identify(docs, fit_languages(docs.filter(may_learn()))).collect()
    left = {x.doc_id for x in named if x.lang_pred != "und" and x.score >= 0.5}
    text = {x.doc_id: x.text for x in docs.collect() if x.doc_id in left}
    best = {}
    for d, t in text.items():
        body = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[body] = min(best.get(body, (1, 0)), (-len(t), d))
    text = {d: text[d] for _, d in best.values()}
    sets = {}
    for d, t in text.items():
        w = SPACE.findall(lower(t))
        sets[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    up = {d: d for d in sets}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b]) if a < b else 0
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    windows = set()
    for r in bench:
        v = WORD.findall(lower(r.text))
        n = min(13, len(v))
        windows |= {tuple(v[i:i + n]) for i in range(len(v) - n + 1 if v else 0)}
    sizes = {len(w) for w in windows}
    want, lib = {}, Tokenizer.from_file(vocabulary())
    for d in (d for d in sets if root(d) == d):
        w, hit = WORD.findall(lower(text[d])), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
        if not (hit and 20 * len(hit) >= len(w)):
            ids = lib.encode(text[d], add_special_tokens=False).ids
            want[d] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                       hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert got == want


def test_stage_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_SMALL).columns == docs.columns


def test_rows_without_an_id_of_their_own(spark):
    """A contaminated or repeated text takes no other row with its null or repeated id along."""
    item = next(x.text for x in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
                if len(WORD.findall(lower(x.text))) >= 13)
    base = [f"w{i}" for i in range(100)]
    near = " ".join(base[:99] + ["end"])
    clean = [(None, "quite another text"), (7, "one more text"), (None, "")]
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(None, item), (7, item), *clean], schema)
    got = corpus_pipeline.decontamination(spark, docs, SF_SMALL).collect()
    assert sorted(map(str, got)) == sorted(map(str, spark.createDataFrame(clean, schema).collect()))
    docs = spark.createDataFrame([(None, " ".join(base)), (None, near), (7, "one more text"), (7, near + " x"), *clean[:1],
                                  (9, "one more text")], schema)
    got = [(x.doc_id, x.text) for x in corpus_pipeline.near_dedup(spark, docs, SF_SMALL).collect()]
    assert len(got) == 3 and (None, "quite another text") in got and (7, "one more text") in got
    assert sum(t.startswith("w0 ") and d is None for d, t in got) == 1


CLASH = ("doc_id long, text string, lang string, _row long, _id long, _letters boolean, row_number int, "
         "`a.b` string, file_path string, number string, grp string")


def _clashing(spark, rows):
    return spark.createDataFrame([(d, t, "en", 77 + i, 5, False, 9, "dot", "p", "n", "g")
                                  for i, (d, t) in enumerate(rows)], CLASH)


@pytest.mark.parametrize("from_files", [False, True])
def test_columns_of_any_name_pass_unchanged(spark, tmp_path, from_files):
    text = "The quick brown fox jumps over the lazy dog and runs far away into the dark green forest. "
    rows = [(i, text + f"It met number {i} there, " + " ".join(f"w{i}x{k}" for k in range(30))) for i in range(20)]
    docs = _clashing(spark, rows)
    if from_files:
        docs.repartition(3).write.parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
    want = sorted(map(str, docs.collect()))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF_SMALL)
        assert got.schema == docs.schema, name
        assert sorted(map(str, got.collect())) == want, name


@pytest.mark.parametrize("from_files", [False, True])
def test_exact_survivor_is_the_longest_then_the_smallest_id(spark, tmp_path, from_files):
    rows = [(5, "a  b"), (1, "ab"), (5, "a b"), (5, "a  b"), (3, " ab "), (None, "q r"), (2, "qr "), (4, "z"), (4, "z"),
            (None, "y"), (None, "y"), (9, ""), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    if from_files:
        docs.repartition(4).write.parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.exact_dedup(spark, docs, SF_SMALL).collect()), key=str)
    assert got == sorted([(3, " ab "), (None, "q r"), (4, "z"), (None, "y"), (8, None)], key=str)


def test_all_stages_on_an_empty_table_and_blank_texts(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    blank = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (None, " ", None)], none.schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, none, SF_SMALL)
        assert got.schema == none.schema and got.collect() == [], name
    assert corpus_pipeline.language_id(spark, blank, SF_SMALL).collect() == []
    for _, stage in corpus_pipeline.STAGES[2:4]:
        assert stage(spark, blank, SF_SMALL).count() == 3


def test_intermediate_tables_are_deleted_when_the_next_stage_begins(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    made = []

    def folders():
        return {p for p in made if Store(spark).exists(p)}

    keep = session.scratch_path

    def noted(*a):
        made.append(keep(*a))
        return made[-1]

    blocks_scratch, blocks.scratch_path = blocks.scratch_path, noted
    try:
        corpus_pipeline.near_dedup(spark, docs, SF_SMALL).write.parquet(str(tmp_path / "one"))
        first = folders()
        assert first
        lazy = corpus_pipeline.decontamination(spark, spark.read.parquet(str(tmp_path / "one")), SF_SMALL)
        assert not first & folders()
        corpus_pipeline.exact_dedup(spark, lazy, SF_SMALL)      # tables that the input reads stay
        assert lazy.count() > 0
    finally:
        blocks.scratch_path = blocks_scratch


def test_many_files_are_numbered_by_a_stored_copy(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i % 3, f"t{i}") for i in range(50)], "doc_id long, text string")
    docs.repartition(5).write.parquet(str(tmp_path / "docs"))
    back = spark.read.parquet(str(tmp_path / "docs"))
    for most in (100_000, 2):
        monkeypatch.setattr(rows_module, "MOST_FILES", most)
        numbered, row = rows_module.with_row_number(back.filter("doc_id < 2"), "t")
        first, second = (sorted(map(tuple, numbered.collect())) for _ in range(2))
        assert first == second and len({r[-1] for r in first}) == back.filter("doc_id < 2").count()
    twice, row = rows_module.with_row_number(back.union(back), "t")
    assert twice.select(row).distinct().count() == 100
