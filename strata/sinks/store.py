"""Small objects and folders through the session's own file systems.

Spark's Hadoop configuration decides the store, so a pointer or a marker lives
where the layers live (``hdfs://``, ``s3a://``, a shared folder) and is reached
with the same endpoint and keys.  Driver-side calls only, on names and small texts;
table data never passes through here.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def is_io_error(e: Py4JJavaError) -> bool:
    """Whether a call failed in the store (no such file system, no answer) rather than in the caller."""
    kind = e.java_exception.getClass()
    while kind is not None:
        if kind.getName() == "java.io.IOException":
            return True
        kind = kind.getSuperclass()
    return False


class Store:
    """File-system calls for one session."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _at(self, path: str):
        p = self.path(path)
        return p.getFileSystem(self._conf), p

    def qualified(self, path: str) -> str:
        """Full path with scheme and authority."""
        fs, p = self._at(path)
        return fs.makeQualified(p).toString().rstrip("/")

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def matches(self, glob: str) -> bool:
        """Whether a glob finds anything."""
        fs, p = self._at(glob)
        return bool(fs.globStatus(p))

    def names(self, path: str) -> list[str]:
        """Names in a folder, sorted; a folder that is not there has none."""
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def make_folder(self, path: str) -> None:
        fs, p = self._at(path)
        fs.mkdirs(p)

    def delete(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.delete(p, True)

    def read_text(self, path: str) -> str | None:
        """The text of a small object, or None when it is not there."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str = "") -> None:
        """Write a new small object; one that exists already is an error."""
        fs, p = self._at(path)
        stream = fs.create(p, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def replace(self, path: str, text: str) -> None:
        """Swap a small object for a new text: readers see the old or the new one, never a part.

        The text is written beside the object and renamed over it in one call.
        """
        import uuid

        fs, p = self._at(path)
        beside = self.path(f"{path}.{uuid.uuid4().hex[:12]}.new")
        self.create(beside.toString(), text)
        full = fs.makeQualified(beside)
        over = self._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self._jvm.java.lang.reflect.Array.newInstance(over.getClass(), 1)
        options[0] = over
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(full.toUri(), self._conf).rename(
            full, fs.makeQualified(p), options)


def scan_roots(df: DataFrame) -> list[str]:
    """Root paths of the file scans of ``df``, qualified: one entry per path that a
    reader was given, however many files lie below it."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    roots = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() not in ("LogicalRelation", "StreamingRelation"):
            continue
        relation = leaf.relation()
        if relation.getClass().getSimpleName() != "HadoopFsRelation":
            continue
        paths = relation.location().rootPaths()
        roots += [paths.apply(k).toString().rstrip("/") for k in range(paths.size())]
    return sorted(set(roots))
