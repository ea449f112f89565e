"""Publishing a run at once: run folders and one pointer.

A run writes all its layers to ``<root>/runs/<run>/`` and is made current by one
swap of the small object ``<root>/CURRENT``.  Readers resolve the pointer once
and then read that run's folders, so they see one run whole, whatever happens
meanwhile: a run that fails half-way leaves nothing but an unnamed folder, and a
frame opened before a swap keeps reading the run that it was opened on.

One writer at a time: the swap refuses when another run was published since
this one began.  There is no log and no time travel; ``retire`` deletes run
folders that are neither current nor among the newest kept ones.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.plans.medallion import (MedallionParams, MedallionResult, read_gold, read_silver, run_medallion,
                                    serve)
from strata.sinks.store import Store
from strata.sources.files import read_json

log = logging.getLogger(__name__)
POINTER, RUNS = "CURRENT", "runs"


class PublishConflict(RuntimeError):
    """Another run was published between the start and the end of this one."""


class RunFolders:
    """The run folders below a lake root, and the pointer to the current one."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self.store = root.rstrip("/"), Store(spark)

    def current(self) -> str | None:
        """Name of the current run, or None before the first one."""
        return self.store.read_text(f"{self.root}/{POINTER}")

    def path(self, run: str) -> str:
        return f"{self.root}/{RUNS}/{run}"

    def new(self) -> str:
        """A name for a new run; names sort by the time they were made."""
        return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S.%f}-{uuid.uuid4().hex[:8]}"

    def publish(self, run: str, since: str | None) -> None:
        """Make ``run`` current if ``since`` is still the current run."""
        now = self.current()
        if now != since:
            raise PublishConflict(f"run {run} began on {since}, but {now} was published meanwhile")
        self.store.replace(f"{self.root}/{POINTER}", run)

    def retire(self, keep: int = 1) -> list[str]:
        """Delete the folders of runs before the current one but for the ``keep`` newest
        (frames may still be open on them); folders newer than the current run stay,
        since a run may be writing there.  Returns the deleted names."""
        now = self.current()
        old = [r for r in self.store.names(f"{self.root}/{RUNS}") if now and r < now]
        gone = old[:max(0, len(old) - keep)]
        for r in gone:
            self.store.delete(self.path(r))
        return gone


def published(spark: SparkSession, p: MedallionParams) -> MedallionParams:
    """``p`` with the root of the current run: the paths to read."""
    folders = RunFolders(spark, p.root)
    run = folders.current()
    if run is None:
        raise FileNotFoundError(f"no run has been published below {p.root}")
    return replace(p, root=folders.path(run))


def open_layers(spark: SparkSession, p: MedallionParams, schema: T.StructType,
                bronze_schema: T.StructType | None = None) -> dict[str, DataFrame]:
    """bronze, silver and gold of the current run; the pointer is read once for all three."""
    at = published(spark, p)
    return {"bronze": read_json(spark, at.bronze_path, bronze_schema or schema),
            "silver": read_silver(spark, at, schema), "gold": read_gold(spark, at, schema)}


def run_published(spark: SparkSession, source: DataFrame, p: MedallionParams,
                  keep: int | None = None) -> MedallionResult:
    """``run_medallion`` into a run folder, then one pointer swap, then serving.

    ``keep``: with a number, older run folders but that many are deleted after
    the swap.  Appending modes and dynamic silver need the folders of the run
    before and are refused.  The result's frames read the new run.
    """
    if p.dynamic_silver or "append" in (p.bronze_mode, p.silver_mode, p.gold_mode):
        raise ValueError("a published run writes whole layers; append and dynamic silver change stored ones")
    folders = RunFolders(spark, p.root)
    since, run = folders.current(), folders.new()
    res = run_medallion(spark, source, replace(p, root=folders.path(run), jdbc=None))
    folders.publish(run, since)
    log.info("published run %s below %s", run, p.root)
    if p.jdbc:
        serve(p, res.silver, res.gold)
    if keep is not None:
        folders.retire(keep)
    return res
