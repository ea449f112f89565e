"""Registered queries of the training-data operators, and their DuckDB SQL.

Each query reads the given tables whole and derives its digest columns from
the outputs of one operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.alignment import alignment
from strata.llm.blob_ledger import BlobLedger, joined_spans
from strata.llm.bpe import digests, encode_documents
from strata.llm.exact_dedup import exact_groups
from strata.llm.folds import held_out, may_learn
from strata.llm.lsh_forest import near_duplicates
from strata.llm.merkle import audit, lowered
from strata.llm.mixing import mix
from strata.llm.phrase_index import contamination
from strata.llm.ppm_language import fit_languages, identify
from strata.llm.substring_dedup import dedup_substrings
from strata.llm.suffix_dedup import dedup_suffixes
from strata.llm.token_rollup import TokenRollup, changes, count_tokens
from strata.llm.toxicity import fit_toxicity, score_toxicity
from strata.session import scratch_path
from strata.sources.files import read_testdata as table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside 13-word windows of benchmark items."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 13, 20).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 50-byte strings that also start in a document with a smaller id, removed."""
    return dedup_suffixes(table(spark, sf_dir, "documents"), length=50).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by class-conditional Kneser-Ney models."""
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of texts that are equal without white space, and the row that stays."""
    return exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of 13-word windows that also start in a document with a smaller id, removed."""
    return dedup_substrings(table(spark, sf_dir, "documents"), window=13).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by partial matching over bytes."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit_languages(docs.filter(may_learn()))).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, found once per distinct text."""
    docs = table(spark, sf_dir, "documents")
    ledger = BlobLedger(spark, scratch_path(spark, "blob-ledger"))
    ledger.scan(docs)

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return ledger.findings(docs).select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(joined_spans(), 256).alias("base_sha256"), joined_spans().alias("spans"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals kept by deltas: estimates are loaded for all documents and then
    revised to the counts, a second tokenizer is loaded, documents without a
    token are deleted again, and one batch is sent twice."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", count_tokens("words-1").alias("words"), count_tokens("alnum-1").alias("alnums"),
        F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("size"))
    size, guess = F.col("size"), F.floor(F.col("size") / 5)
    rollup = TokenRollup(spark, scratch_path(spark, "token-rollup"))
    rollup.commit("load-words", changes(docs, "words-1", "insert", n_tokens=guess, n_chars=size))
    revised = changes(docs, "words-1", "revise", n_tokens=F.col("words"), n_chars=size, old_tokens=guess, old_chars=size)
    rollup.commit("revise-words", revised)
    rollup.commit("load-alnum", changes(docs, "alnum-1", "insert", n_tokens=F.col("alnums"), n_chars=size))
    empty = docs.filter("words = 0")
    rollup.commit("drop-empty", changes(empty, "words-1", "delete", n_tokens=F.col("words"), n_chars=size).unionByName(
        changes(empty, "alnum-1", "delete", n_tokens=F.col("alnums"), n_chars=size)))
    rollup.commit("revise-words", revised)
    return rollup.totals().select("source", "lang", "version", "n_docs", "n_tokens", "n_chars")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with alike 4-word shingle sets, and the one that stays."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80).select(
        "doc_id", "n_shingles", "component_id", "kept")


def vocabulary() -> str:
    """Default vocabulary file of the encoder."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document, as count and digests."""
    return digests(encode_documents(table(spark, sf_dir, "documents"), vocabulary()))


def tokenizer_files() -> tuple[str, str]:
    """Default byte-level and piece vocabularies of the alignment."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned in every document, and their links held against the corpus."""
    return alignment(table(spark, sf_dir, "documents"), *tokenizer_files()).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of the documents, with proofs checked against a copy that
    lower-cases the texts of every fifth crc32."""
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return audit(table(spark, sf_dir, "documents"), picked, lowered()).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources meet their word targets, at least change of rates."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_language": op6_language,
    "op7_secrets": op7_secrets,
    "op8_token_counts": op8_token_counts,
    "op9_near_dedup": op9_near_dedup,
    "op10_bpe": op10_bpe,
    "op11_alignment": op11_alignment,
    "op12_manifest": op12_manifest,
    "op13_mixing": op13_mixing,
}


def _manifest_sql(levels: int = 6, fanout: int = 16) -> str:
    """DuckDB SQL of op12: one CTE per level, for up to ``fanout ** levels`` rows a source."""
    def cell(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(strlen({c}::VARCHAR), ':', {c}::VARCHAR) END"

    def leaf(text: str) -> str:
        return f"sha256(concat({', '.join(cell(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))}))"

    def climb(name: str) -> str:
        return ", ".join(f"""
        {name}{k + 1} AS (
            SELECT grp, pos // {fanout} AS pos, ceil(any_value(n) / {fanout})::BIGINT AS n,
                   CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h
            FROM {name}{k} GROUP BY grp, pos // {fanout}),
        {name}way{k} AS (
            SELECT grp, pos, n,
                   coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lo,
                   coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS hi
            FROM {name}{k} WINDOW w AS (PARTITION BY grp, pos // {fanout} ORDER BY pos))""" for k in range(levels))

    ways = [("l", k) for k in range(levels)] + [("r", k) for k in range(levels)]
    steps = ", ".join(f"{{'v': '', 'lo': {t}w{k}.lo, 'hi': {t}w{k}.hi, 'n': {t}w{k}.n}}" for t, k in ways)
    fold = (f"list_reduce([{{'v': claimed, 'lo': '', 'hi': '', 'n': 1::BIGINT}}, {steps}], lambda a, s: "
            "{'v': CASE WHEN s.n = 1 THEN a.v ELSE sha256(s.lo || a.v || s.hi) END, 'lo': '', 'hi': '', 'n': 1::BIGINT}).v")
    joins = "".join(f" JOIN {t}way{k} {t}w{k} ON {t}w{k}.grp = {'l0.grp' if t == 'l' else 'r0.grp'} "
                    f"AND {t}w{k}.pos = {t}0.pos // {fanout ** k}" for t, k in ways)
    return f"""
        WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], repeat([0::BIGINT], 8)),
                        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps),
        base AS (
            SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS grp, {leaf('text')} AS h,
                   {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS other,
                   xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''),
                       lambda d: ascii(d)::BIGINT)), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) AS crc
            FROM documents, crc),
        l0 AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
                      count(*) OVER (PARTITION BY grp) AS n,
                      CASE WHEN crc % 5 = 0 THEN other ELSE h END AS claimed FROM base), {climb('l')},
        r0 AS (SELECT '' AS grp, grp AS member, h, row_number() OVER (ORDER BY grp) - 1 AS pos,
                      count(*) OVER () AS n FROM l{levels}), {climb('r')},
        proofs AS (
            SELECT l0.doc_id, l0.h AS leaf, r0.h AS subroot, r{levels}.h AS root,
                   sha256(concat({', '.join(f'{t}w{k}.lo, {t}w{k}.hi' for t, k in ways)})) AS proof_sha256,
                   {fold} AS folded_root
            FROM l0 JOIN r0 ON r0.member = l0.grp CROSS JOIN r{levels}{joins})
        SELECT *, folded_root = root AS verified FROM proofs"""


ORACLE_SQL: dict[str, str] = {
    "op12_manifest": _manifest_sql(),
    "op8_token_counts": r"""
        WITH t AS (SELECT source, lang, length(coalesce(text, '')) AS size,
                          len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
                          len(regexp_extract_all(coalesce(text, ''), '[0-9A-Za-z]+')) AS alnums
                   FROM documents)
        SELECT source, lang, version, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens,
               CAST(sum(size) AS BIGINT) AS n_chars
        FROM (SELECT source, lang, size, words, 'words-1' AS version, words AS n FROM t
              UNION ALL SELECT source, lang, size, words, 'alnum-1', alnums FROM t)
        WHERE words > 0 GROUP BY 1, 2, 3""",
    "op4_exact_dedup": r"""
        WITH t AS (SELECT doc_id, coalesce(length(text), 0) AS size,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
                   FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER (PARTITION BY body ORDER BY size DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY body) AS group_size,
               doc_id = first_value(doc_id) OVER (PARTITION BY body ORDER BY size DESC, doc_id) AS kept,
               sha256(body) AS text_sha256
        FROM t""",
}
