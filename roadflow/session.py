"""Session helpers.

``build_session`` is for local runs and tests. On a cluster the caller brings
its own session; the library only needs the session time zone to be UTC and a
shared checkpoint directory (``spark.checkpoint.dir``) for lineage cuts and
streaming state.
"""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession


STATE_STORE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_HDFS_PROVIDER = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def build_session(master: str | None = None, app_name: str = "roadflow",
                  shuffle_partitions: int = 8, conf: dict[str, str] | None = None) -> SparkSession:
    """Local/test session: UTC, AQE on, UI off, small shuffle fan-out."""
    builder = (
        SparkSession.builder.appName(app_name)
        .master(master or "local[*]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(STATE_STORE_PROVIDER, ROCKSDB_PROVIDER)
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are UTC; date_trunc/hour/date casts follow the session zone."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def prefer_rocksdb_state(spark: SparkSession) -> SparkSession:
    """Streaming state in RocksDB (off-heap, incremental checkpoints) unless the
    session chose a provider. Takes effect for queries started afterwards with
    a new checkpoint; an existing checkpoint keeps the provider it was made with."""
    if spark.conf.get(STATE_STORE_PROVIDER, _HDFS_PROVIDER) == _HDFS_PROVIDER:
        spark.conf.set(STATE_STORE_PROVIDER, ROCKSDB_PROVIDER)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled",
                       "true")
    return spark


@contextmanager
def shuffle_partitions(spark: SparkSession, n: int | None) -> Iterator[None]:
    """Start streaming queries with ``n`` state partitions, leaving the session as it was.

    A stateful query fixes its partition count from ``spark.sql.shuffle.partitions``
    when its checkpoint is created (later runs ignore the setting); the streaming
    engine clones the session at ``start()``, so the value only has to hold
    while the query starts.
    """
    if n is None:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def default_parallelism(spark: SparkSession) -> int | None:
    context = _context(spark)
    return context.defaultParallelism if context is not None else None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the session names.

    Where it is unset, a local master gets a private folder (removed when Python ends); on a cluster
    that would be another folder on every machine, so there it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = _context(spark)
    if not root and context is not None:
        root = context.getCheckpointDir()
    if not root:
        if context is None or not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="roadflow-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        context.setCheckpointDir(root)
    return root


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Entries of the pattern's own file system that match it, in order of their names; nothing is read."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(jpath)
    paths = [f.getPath() for f in found] if found is not None else []
    return [p.toString() for p in sorted(paths, key=lambda p: p.getName())]


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file, and its folder, on the path's own file system."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).create(jpath, True).close()


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there, on the path's own file system."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def ensure_dir(spark: SparkSession, path: str) -> None:
    """Create a folder on the table's own file system (local, HDFS, object store)."""
    if "://" not in path:
        os.makedirs(path, exist_ok=True)
        return
    if _context(spark) is None:  # Spark Connect: no driver-side file system access
        return
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(jpath)


def ship_package(spark: SparkSession) -> str:
    """Send this package to the executors' Python, as a zip in the shared folder; returns its path.

    Operators whose work runs in Python workers need it there. Not needed where the package is installed on all machines or was given to
    ``spark-submit --py-files``."""
    package = Path(__file__).parent
    with io.BytesIO() as raw:
        with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(package.rglob("*")):
                if f.is_file() and "__pycache__" not in f.parts:
                    z.write(f, f.relative_to(package.parent))
        content = raw.getvalue()
    path = f"{scratch_dir(spark, 'package')}/{package.name}.zip"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).create(jpath, True)
    out.write(bytearray(content))
    out.close()
    spark.sparkContext.addPyFile(path)
    return path


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        return None


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, never reused directory under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    path = os.path.join(root, "roadflow", f"{name}-{uuid.uuid4().hex}")
    if "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path
