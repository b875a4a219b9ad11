"""Session helpers: scale settings, the shared checkpoint folder, durable materialisation.

Library code never creates a session; it takes the caller's.  ``local_session`` is
only for tests and the bench.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale.  AQE re-plans joins at run time, coalesces small
# shuffle partitions and splits skewed join partitions (a hot key becomes several
# tasks instead of one straggler).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "kestrel",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, no ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("KESTREL_DRIVER_MEMORY", "8g"))
    )
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local_master(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a folder every executor can reach); we only
    invent one for a single-JVM local master, as tests do.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception as e:  # noqa: BLE001 - e.g. a Spark Connect session has no SparkContext
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder that every "
                           "executor can reach") from e
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not _is_local_master(sc.master or ""):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/ABFS) "
            "that every executor can reach")
    local_dir = tempfile.mkdtemp(prefix="kestrel-ckpt-", dir="/tmp")
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir().rstrip("/")


# Scratch folders live as long as the innermost open scope of their thread, else as long as the session's process.
_open = threading.local()
_of_session: dict[str, tuple] = {}  # path -> (jvm, Hadoop configuration)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder.

    Results are read lazily, so it stays until the surrounding :func:`scratch_scope` closes; without one until
    :func:`release_scratch` or the end of the driver's process."""
    path = f"{checkpoint_root(spark)}/kestrel/{name}-{uuid.uuid4().hex}"
    if scopes := getattr(_open, "scopes", []):
        scopes[-1].append(path)
    else:
        _of_session[path] = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    return path


def _delete(jvm, conf, path: str) -> None:
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).delete(target, True)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system it lives in (nothing happens if it is gone)."""
    _of_session.pop(path, None)
    _delete(spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving whatever scratch folders are made inside: read or write the results of queries before."""
    scopes = _open.scopes = getattr(_open, "scopes", [])
    own: list[str] = []
    scopes.append(own)
    try:
        yield
    finally:
        scopes.pop()
        for path in own:
            delete_path(spark, path)


def release_scratch() -> None:
    """Delete the scratch folders that belong to no scope; runs by itself when the driver's process ends."""
    while _of_session:
        path, (jvm, conf) = _of_session.popitem()
        try:
            _delete(jvm, conf, path)
        except Exception:  # noqa: BLE001 - the JVM may be gone already
            return


atexit.register(release_scratch)


def materialize(df: DataFrame, name: str, *, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back.

    This cuts the lineage: if an executor is lost, later stages read the written files
    instead of re-running the upstream joins and aggregations.  Nothing is cached.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


class Scratch:
    """Materialised tables of one job and the folders to delete when it is done."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def materialize(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        return materialize(df, name, path=path)

    def close(self) -> None:
        while self.paths:
            delete_path(self.spark, self.paths.pop())

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *exc) -> None:
        self.close()
