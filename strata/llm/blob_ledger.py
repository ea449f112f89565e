"""Secret scans with an incremental ledger of content-addressed blobs.

Every version of every text is a blob, named by the SHA-256 of its bytes.  The
ledger holds, per blob and rule version, what the rules found; a scan reads
only blobs that the ledger does not have under the current rule version, and
findings are joined back to all rows that carry the blob.  A scan appends in
one committed write, so a failed one leaves the ledger as it was and is simply
repeated.

A ledger is opened with a rule set and its version; under another version the same
blobs are unseen, and the older findings stay as they are.

Rules: patterns, leftmost and non-overlapping per kind, matches that are too short
dropped.  Offsets are code points, end exclusive.  Defined cases: null text is the
empty blob; every input row gives a row, copies and null ids included; texts are
scanned whole, whatever their length; an empty table scans nothing and has no
findings; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.blocks import limit_batches, stored, texts

RULE_VERSION = 1
#: Kinds in order, with pattern, group that is measured, and its least length (fixed values).
RULES = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    "access": (r"AKIA[A-Z0-9]+", 0, 20, False),
    "hex": (r"[0-9a-f]+", 0, 24, False),
}
#: A text without a match of these has no finding of the kind (linear-time search).
HINTS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
    "access": r"AKIA[A-Z0-9]{16}",
    "hex": r"[0-9a-f]{24}",
}
SALTS = 32
_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                      T.StructField("end", T.IntegerType())])
LEDGER = T.StructType([T.StructField("blob", T.StringType()), T.StructField("rules", T.IntegerType()),
                       T.StructField("spans", T.ArrayType(_SPAN))])


def _patterns(rules: dict = RULES) -> list[tuple[str, re.Pattern, int, int]]:
    out = []
    for kind, (pattern, group, least, any_case) in rules.items():
        # a run of [0-9a-f] below the least length fails as a whole, so it need not be visited
        text = f"[0-9a-f]{{{least},}}" if pattern == "[0-9a-f]+" else pattern
        out.append((kind, re.compile(text, re.ASCII | (re.IGNORECASE if any_case else 0)), group, least))
    return out


def find_spans(text: str, kinds: set[str] | None = None, rules: dict = RULES) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all findings, by start and then kind as listed."""
    found = []
    for rank, (kind, pattern, group, least) in enumerate(_patterns(rules)):
        if kinds is None or kind in kinds:
            found += [(m.start(), rank, kind, m.end()) for m in pattern.finditer(text)
                      if m.end(group) - m.start(group) >= least]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def _compress(batches):
    z = zstandard.ZstdCompressor(level=1)
    for b in batches:
        body = [z.compress(x) for x in b.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("blob"), pa.array(body, pa.binary())], ["blob", "body"])


def _scan(rules: dict, version: int):
    """Scan decompressed blobs; kinds of the built-in rules are searched only where their hint is."""
    hints = {k: HINTS[k] for k in rules if rules[k] == RULES.get(k)}
    others = set(rules) - set(hints)

    def run(batches):
        z = zstandard.ZstdDecompressor()
        arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for b in batches:
            text = pa.array([z.decompress(x) for x in b.column("body").to_pylist()], pa.binary()).cast(pa.string())
            spans: list[list[tuple]] = [[] for _ in range(b.num_rows)]
            hits = {k: pc.match_substring_regex(text, h).to_numpy(zero_copy_only=False) for k, h in hints.items()}
            todo = range(b.num_rows) if others else set().union(*(x.nonzero()[0].tolist() for x in hits.values()))
            for i in todo:
                spans[i] = find_spans(text[i].as_py(), others | {k for k in hits if hits[k][i]}, rules)
            cells = [[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in spans]
            yield pa.RecordBatch.from_arrays(
                [b.column("blob"), pa.array([version] * b.num_rows, pa.int32()), pa.array(cells, arrow)],
                ["blob", "rules", "spans"])
    return run


def blobs(docs: DataFrame) -> DataFrame:
    """doc_id, text and blob name of every row."""
    t = texts(docs).withColumn("text", F.coalesce("text", F.lit("")))
    return t.withColumn("blob", F.sha2(F.col("text").cast("binary"), 256))


class BlobLedger:
    """A ledger table at ``path`` (a shared folder), read and written under one rule version."""

    def __init__(self, spark: SparkSession, path: str, rules: dict = RULES, version: int = RULE_VERSION):
        if rules != RULES and version == RULE_VERSION:
            raise ValueError(f"version {RULE_VERSION} names the built-in rules; give other rules another version")
        self.spark, self.path, self.rules, self.version = spark, path, rules, version
        spark.createDataFrame([], LEDGER).write.mode("append").parquet(path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def scan(self, docs: DataFrame) -> None:
        """Scan the blobs of ``docs`` that are new under the current rules."""
        known = self.read().filter(F.col("rules") == self.version).select("blob")
        limit_batches(self.spark, 512)
        bodies = blobs(docs).select("blob", "text").mapInArrow(_compress, "blob string, body binary")
        new = bodies.dropDuplicates(["blob"]).join(known, "blob", "left_anti")
        new.mapInArrow(_scan(self.rules, self.version), LEDGER).write.mode("append").parquet(self.path)

    def findings(self, docs: DataFrame) -> DataFrame:
        """doc_id, blob and spans of every row of ``docs``, under the current rules.

        The join back goes by (blob, salt), so that the rows of one hot blob
        are dealt to several tasks.
        """
        rows = stored(blobs(docs).select("doc_id", "blob", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt")),
                      "ledger-paths")
        found = (self.read().filter(F.col("rules") == self.version)
                 .groupBy("blob").agg(F.any_value("spans").alias("spans")))       # two runs may have raced
        return (rows.join(rows.select("blob", "salt").distinct().join(found, "blob"), ["blob", "salt"])
                .select("doc_id", "blob", "spans"))


def joined_spans(spans: str = "spans"):
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(F.col(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
