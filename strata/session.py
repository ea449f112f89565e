"""Session profile (F6), object-store settings (S5) and shared-folder helpers.

Nothing here creates a session on import.  ``session_conf`` returns plain
dictionaries so a caller (spark-submit, a notebook, a test) can apply them in
whatever way suits the deployment.
"""

from __future__ import annotations

import glob
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every profile shares: adaptive execution re-plans at each shuffle
# boundary (coalesces small partitions, splits skewed ones, switches join
# strategy on measured sizes); timestamps are handled in UTC.
_COMMON = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.network.timeout": "600s",
    "spark.executor.heartbeatInterval": "60s",
}

_PROFILES = {
    # One JVM; shuffle partitions sized to the cores, not to the data.  Tables
    # here are ~100 MB, so AQE targets 4 MB partitions: a 64 MB target would
    # leave most cores idle (a hot value is split, a write gets several tasks).
    "local": {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(4 * 1024 * 1024),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    },
    # Large cluster: start with many shuffle partitions and let AQE coalesce
    # them to ~128 MB each; split input files at 256 MB.
    "cluster": {
        "spark.sql.shuffle.partitions": "4000",
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * 1024 * 1024),
        # honour the advisory size instead of maximising task count
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.task.maxFailures": "8",
        "spark.stage.maxConsecutiveAttempts": "8",
        # No speculation: paced crawl tasks are slow on purpose, and a
        # speculative copy would repeat requests against the API.
        "spark.speculation": "false",
    },
}


def delta_available() -> bool:
    """True when a Delta Lake jar is on the local Spark classpath."""
    import pyspark

    roots = [os.path.join(os.path.dirname(pyspark.__file__), "jars")]
    if os.environ.get("SPARK_HOME"):
        roots.append(os.path.join(os.environ["SPARK_HOME"], "jars"))
    return any(glob.glob(os.path.join(r, "delta-spark*.jar")) for r in roots)


def session_conf(profile: str = "local", with_delta: bool | None = None) -> dict[str, str]:
    """Configuration dictionary for a profile (``local`` or ``cluster``).

    Delta's SQL extension and catalog are added only when asked for or when the
    jar is present, because naming a missing extension class fails at startup.
    """
    if profile not in _PROFILES:
        raise ValueError(f"unknown profile {profile!r}; expected one of {sorted(_PROFILES)}")
    conf = dict(_COMMON)
    conf.update(_PROFILES[profile])
    if with_delta is None:
        with_delta = delta_available()
    if with_delta:
        conf["spark.sql.extensions"] = "io.delta.sql.DeltaSparkSessionExtension"
        conf["spark.sql.catalog.spark_catalog"] = "org.apache.spark.sql.delta.catalog.DeltaCatalog"
    return conf


def object_store_conf(
    endpoint: str,
    access_key: str | None = None,
    secret_key: str | None = None,
    path_style: bool = True,
    ssl: bool | None = None,
) -> dict[str, str]:
    """``spark.hadoop.fs.s3a.*`` settings for an S3-compatible store.

    Keys default to the standard ``AWS_ACCESS_KEY_ID`` / ``AWS_SECRET_ACCESS_KEY``
    environment variables; they are never written into code or logs.
    """
    access_key = access_key if access_key is not None else os.environ.get("AWS_ACCESS_KEY_ID")
    secret_key = secret_key if secret_key is not None else os.environ.get("AWS_SECRET_ACCESS_KEY")
    if ssl is None:
        ssl = endpoint.startswith("https://")
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
    if access_key and secret_key:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
        conf["spark.hadoop.fs.s3a.aws.credentials.provider"] = (
            "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"
        )
    return conf


def apply_object_store_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Apply ``spark.hadoop.*`` settings to a running session.

    Session SQL settings are copied into the Hadoop configuration of every
    DataFrame read and write, so setting the keys without the
    ``spark.hadoop.`` prefix takes effect for later I/O without touching the
    JVM context directly.
    """
    for k, v in conf.items():
        spark.conf.set(k[len("spark.hadoop."):] if k.startswith("spark.hadoop.") else k, v)


def build_session(
    app_name: str = "strata",
    master: str | None = None,
    profile: str = "local",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Convenience builder for scripts and tests; library code never calls it."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = session_conf(profile)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def _context(spark: SparkSession):
    """The SparkContext, or None for a Spark Connect session (which has none)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def default_parallelism(spark: SparkSession) -> int:
    """Tasks the cluster runs at once (falls back to the shuffle partition count)."""
    sc = _context(spark)
    if sc is not None:
        return int(sc.defaultParallelism)
    return int(spark.conf.get("spark.default.parallelism", None)
               or spark.conf.get("spark.sql.shuffle.partitions"))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for checkpoints and intermediate tables.

    Order: a directory already set on the context, then the ``spark.checkpoint.dir``
    setting.  With neither this raises, whatever the master: a folder that only one
    machine sees would not survive the loss of an executor, so the library never
    makes one up.
    """
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = (sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None) \
        or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder that the driver and all executors share "
            "(HDFS, S3; any folder for a local session)"
        )
    if sc is None:
        # Spark Connect: the server applies the setting to checkpoint().
        spark.conf.set("spark.checkpoint.dir", configured)
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables, under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    # getCheckpointDir() returns a per-application sub-folder; keep tables beside it.
    path = f"{root}/strata-tables/{name}-{uuid.uuid4().hex[:12]}"
    for owner in _open.get(id(spark), []):
        _scratch.setdefault((id(spark), owner), []).append(path)
    return path


# Scratch folders by session and owner, while the owner records them.
_open: dict[int, list[str]] = {}
_scratch: dict[tuple[int, str], list[str]] = {}


@contextmanager
def scratch_in_use(spark: SparkSession, owner: str) -> Iterator[None]:
    """Record the scratch folders that are made inside the block under ``owner``."""
    _open.setdefault(id(spark), []).append(owner)
    try:
        yield
    finally:
        _open[id(spark)].remove(owner)


def release_scratch(spark: SparkSession, owner: str, keep: list[str] | None = None) -> list[str]:
    """Delete the scratch folders recorded under ``owner``, but for those that hold a path of ``keep``
    (they stay recorded).  Call it when everything read from them has been written.  Returns the deleted paths."""
    from strata.sinks.store import Store

    store, left, gone = Store(spark), [], []
    held = [k.rstrip("/") + "/" for k in keep or []]
    for path in _scratch.get((id(spark), owner), []):
        if any(k.startswith(store.qualified(path) + "/") for k in held):
            left.append(path)
        else:
            store.delete(path)
            gone.append(path)
    _scratch[(id(spark), owner)] = left
    return gone
