"""Merkle manifest of a table: leaf per row, subtree per group, one root.

Every level of a tree is a stored table (grp, pos, n, hash): node ``pos`` of the
``n`` nodes that the group has there.  Consecutive nodes form runs of
``FANOUT``.  A window over each run takes the digests at fixed offsets (lag and
lead 1 to 15); an offset counts only where the node's slot and the run's length
allow it.  A node's siblings are those columns in order, and the first child's
own digest with its leads is what the parent hashes.  Positions come from a
range partitioning, so no window and no task holds more of a hot group than a
run or a range.

A node's way up is a list of (left, right) sibling texts.  Lists are built from
the top down, one per inner node, and shared by the node's children, so the
lists that are stored or shuffled are a sixteenth of the leaves.

Defined cases: a null column is ``-`` in its leaf; a null group is a group of
its own before all others, a null order key comes first in its group; rows with
equal order keys are ordered by their leaves, and equal leaves are
interchangeable; a group of one row has its leaf as subroot, a single group its
subroot as root; an empty table has no root and gives no rows; texts of any
length are hashed whole, as one value; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.blocks import stored
from strata.llm.positions import positions

FANOUT = 16
STEPS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the concatenated texts."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` for null, else byte count, colon, text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: list[Column]) -> Column:
    return digest(*[field(v) for v in values])


def group_key(group: Column) -> Column:
    """Text without nulls that sorts null first, then by UTF-8 bytes."""
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group.cast("string")))


def with_siblings(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``nodes`` with run, slot and the joined digests of the run's others: left and right."""
    slot = F.pmod(F.col("pos"), F.lit(fanout))
    run = ((F.col("pos") - slot) / fanout).cast("long")
    nodes = nodes.withColumn("run", run).withColumn("slot", slot)
    length = F.least(F.lit(fanout), F.col("n") - F.col("run") * fanout)
    w = Window.partitionBy("grp", "run").orderBy("pos")
    none = F.lit("")
    before = [F.when(F.col("slot") >= k, F.lag("hash", k).over(w)).otherwise(none) for k in range(fanout - 1, 0, -1)]
    after = [F.when(F.col("slot") + k < length, F.lead("hash", k).over(w)).otherwise(none) for k in range(1, fanout)]
    return nodes.withColumns({"left": F.concat(*before), "right": F.concat(*after)})


def parents(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The next level: a run's first child hashes itself and its leads."""
    return (with_siblings(nodes.select("grp", "pos", "n", "hash"), fanout).filter("slot = 0")
            .select("grp", F.col("run").alias("pos"), F.ceil(F.col("n") / fanout).cast("long").alias("n"),
                    digest(F.col("hash"), F.col("right")).alias("hash")))


def tree(leaves: DataFrame, name: str, fanout: int = FANOUT) -> list[DataFrame]:
    """All levels, leaves first; a group's last node is the one with n = 1."""
    levels, most = [leaves], leaves.agg(F.max("n")).head()[0] or 0
    while most > 1:
        levels.append(stored(parents(levels[-1].filter("n > 1"), fanout), f"{name}-{len(levels)}"))
        most = -(-most // fanout)
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """grp and hash of every group's top node."""
    out = levels[0].filter("n = 1").select("grp", "hash")
    for nodes in levels[1:]:
        out = out.unionByName(nodes.filter("n = 1").select("grp", "hash"))
    return out


def _level_ways(nodes: DataFrame, above: DataFrame | None, top: DataFrame, fanout: int) -> DataFrame:
    """Every column of ``nodes`` with top and steps: the node's way up to the root."""
    lone = nodes.filter("n = 1").join(top, "grp").select(*nodes.columns, "top", "steps")
    if above is None:
        return lone
    step = F.array(F.struct("left", "right"))
    many = (with_siblings(nodes.filter("n > 1"), fanout)
            .join(above.select("grp", F.col("pos").alias("run"), "top", "steps"), ["grp", "run"])
            .select(*nodes.columns, "top", F.concat(step, "steps").alias("steps")))
    return lone.unionByName(many)


def ways(levels: list[DataFrame], top: DataFrame, name: str, fanout: int = FANOUT) -> DataFrame:
    """The leaves with their way up.  ``top``: grp, top (digest of the group's
    top node) and steps (that node's own way up)."""
    above = None
    for i in range(len(levels) - 1, 0, -1):
        found = _level_ways(levels[i], above, top, fanout)
        above = stored(found.select("grp", "pos", "top", "steps"), f"{name}-way-{i}")
    return _level_ways(levels[0], above, top, fanout)


def fold(start: Column, steps: Column) -> Column:
    """The digest that a leaf reaches when its siblings are hashed in level by level."""
    return F.aggregate(steps, start, lambda acc, s: digest(s["left"], acc, s["right"]))


def proof(steps: Column) -> Column:
    """Digest of all sibling digests of a way up."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


class Manifest:
    """Trees over ``docs``: a leaf per row of ``fields``, a subtree per ``group``
    ordered by ``order``, a root tree over the subroots.

    ``carry`` holds further columns of each row that come back with its proof
    (a claimed leaf, for one).  Levels are stored in the shared scratch folder.
    """

    def __init__(self, docs: DataFrame, fields: list[str], group: str, order: str,
                 carry: dict[str, Column] | None = None, fanout: int = FANOUT):
        self.fanout, self.spark = fanout, docs.sparkSession
        rows = docs.select(F.col(order).alias("key"), group_key(F.col(group)).alias("grp"),
                           leaf([F.col(f) for f in fields]).alias("hash"),
                           *[c.alias(f"carry_{k}") for k, c in (carry or {}).items()])
        self.carried = list(carry or {})
        # stored once more: every level reads positions, none sorts the rows again
        self.leaves = stored(positions(rows, ["grp"], [F.col("key"), F.col("hash")], "merkle-rows"), "merkle-leaves")
        self.levels = tree(self.leaves, "merkle", fanout)
        self.subroots = stored(tops(self.levels), "merkle-subroots")
        self.root_levels = tree(self._root_leaves(), "merkle-root", fanout)
        top = tops(self.root_levels).head()
        self.root = top["hash"] if top else None

    def _root_leaves(self) -> DataFrame:
        rows = self.subroots.select(F.lit("").alias("grp"), F.col("grp").alias("member"), "hash")
        return stored(positions(rows, ["grp"], [F.col("member")], "merkle-root-rows"), "merkle-root-leaves")

    def proofs(self) -> DataFrame:
        """key, leaf, subroot, root, steps and the carried columns of every row."""
        whole = _one_row(self.spark, self.root)
        top = ways(self.root_levels, whole, "merkle-root", self.fanout).select(
            F.col("member").alias("grp"), F.col("hash").alias("top"), "steps")
        return ways(self.levels, stored(top, "merkle-tops"), "merkle", self.fanout).select(
            "key", F.col("hash").alias("leaf"), F.col("top").alias("subroot"), F.lit(self.root).alias("root"), "steps",
            *[F.col(f"carry_{k}").alias(k) for k in self.carried])


def _one_row(spark: SparkSession, root: str | None) -> DataFrame:
    return spark.range(1).select(F.lit("").alias("grp"), F.lit(root).cast("string").alias("top"),
                                 F.array().cast(STEPS).alias("steps"))


def verified(proofs: DataFrame, claimed: Column) -> DataFrame:
    """``proofs`` with proof_sha256, folded_root (from the claimed leaf and the
    stored siblings) and verified."""
    return (proofs.withColumn("proof_sha256", proof(F.col("steps")))
            .withColumn("folded_root", fold(claimed, F.col("steps")))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


#: Columns of ``documents`` that a leaf covers, in order.
DOCUMENT_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def lowered(text: str = "text") -> Column:
    """A-Z in lower case, nothing else changed."""
    return F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audit(docs: DataFrame, tampered: Column, change: Column, fanout: int = FANOUT) -> DataFrame:
    """Manifest of ``documents`` held against a copy in which the rows that
    ``tampered`` marks carry ``change`` as their text."""
    other = leaf([F.col(c) if c != "text" else change for c in DOCUMENT_FIELDS])
    manifest = Manifest(docs, DOCUMENT_FIELDS, "source", "doc_id",
                        {"claimed": F.when(F.coalesce(tampered, F.lit(False)), other)}, fanout)
    found = verified(manifest.proofs(), F.coalesce("claimed", "leaf"))
    return found.withColumnRenamed("key", "doc_id")
