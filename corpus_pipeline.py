"""Corpus pipeline: language ID, exact dedup, near-dedup, decontamination, encoding.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``docs``.

The dedup stages and decontamination decide by row: each row has a number that
stands for its doc_id in the operators, so rows with a null or a repeated doc_id
are documents of their own.

A stage's intermediate tables are deleted when the next stage begins, for by then
its result is written; tables that the given ``docs`` still reads stay.

Defined cases, for all stages: a null or empty text is rejected by language ID and
would pass every later stage; in a group of equal or alike texts one row stays, the
longest text (exact) or the smallest doc_id (near; a null one is the smallest),
ties by doc_id, then by the text's hash, then any one of rows that are equal in
all of these; texts are taken whole, whatever their length; an empty table gives an
empty table with the same columns; columns of any name pass through unchanged.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.blocks import stored
from strata.llm.bpe import digests, encode_documents
from strata.llm.exact_dedup import exact_groups
from strata.llm.folds import may_learn
from strata.llm.lsh_forest import near_duplicates
from strata.llm.phrase_index import contamination
from strata.llm.ppm_language import fit_languages, keep_identified
from strata.llm.queries import vocabulary
from strata.llm.rows import with_row_number
from strata.session import release_scratch, scratch_in_use
from strata.sinks.store import scan_roots
from strata.sources.files import read_testdata


def stage(function):
    """A stage function that deletes the intermediate tables of the stage before it."""
    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_scratch(spark, "pipeline", keep=scan_roots(docs))
        with scratch_in_use(spark, "pipeline"):
            return function(spark, docs, sf_dir)
    return run


def _numbered(docs: DataFrame, name: str) -> tuple[DataFrame, DataFrame, str]:
    """(docs with row numbers, the operators' view of it: the number as doc_id, the number's column)."""
    rows, row = with_row_number(docs, name)
    return rows, rows.select(F.col(row).alias("doc_id"), "text"), row


def _survivors(rows: DataFrame, row: str, groups: DataFrame, order: list[Column]) -> DataFrame:
    """Row numbers (column ``row``) of the first row under ``order`` of each group (number, grp)."""
    key = F.struct(*order, F.col("doc_id").cast("long").alias("id"),
                   F.sha2(F.col("text").cast("string"), 256).alias("sha"), F.col(row).alias("number"))
    narrow = rows.select(F.col(row).alias("number"), key.alias("place"))
    return (narrow.join(groups, "number").groupBy("grp").agg(F.min("place").alias("place"))
            .select(F.col("place.number").alias(row)))


@stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; texts without a letter go."""
    return keep_identified(docs, fit_languages(docs.filter(may_learn())))


@stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal without white space: the longest, then the smallest doc_id."""
    rows, view, row = _numbered(docs, "exact-rows")
    groups = exact_groups(view, unique_ids=True).select(F.col("doc_id").alias("number"), F.col("keep_id").alias("grp"))
    size = (-F.coalesce(F.char_length(F.col("text").cast("string")), F.lit(0))).alias("size")
    return rows.join(_survivors(rows, row, groups, [size]), row, "left_semi").select(*_columns(docs))


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of alike 5-word shingle sets: the smallest doc_id, then text hash."""
    rows, view, row = _numbered(docs, "near-rows")
    groups = near_duplicates(view, words=5, percent=80).select(
        F.col("doc_id").alias("number"), F.col("component_id").alias("grp"))
    return rows.join(_survivors(rows, row, groups, []), row, "left_semi").select(*_columns(docs))


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not made up of benchmark passages to a twentieth or more."""
    rows, view, row = _numbered(docs, "contamination-rows")
    bad = (contamination(view, read_testdata(spark, sf_dir, "benchmark")).filter("contaminated")
           .select(F.col("doc_id").alias(row)))
    return rows.join(bad, row, "left_anti").select(*_columns(docs))


@stage
def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document that is left."""
    return digests(encode_documents(docs, vocabulary()))


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("BPE encoding", encoding),
]

#: Language ID has no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table."""
    docs = read_testdata(spark, sf_dir, "documents")
    for i, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            with scratch_in_use(spark, "pipeline"):
                docs = stored(docs, "stage-" + name.replace(" ", "-").lower())
    return docs
