"""Session construction and the shared scratch folder.

Intermediate tables (round checkpoints of the clump, materialised
text fixtures) go to the folder the cluster names in ``spark.checkpoint.dir``.
A folder of our own is created only when the session has none, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "polyscore", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    event_log = os.environ.get("POLYSCORE_EVENT_LOG")
    if event_log:  # stage/task timings for profiling, written to a scratch folder (no UI)
        os.makedirs(local_path(event_log), exist_ok=True)
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log})
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Datasets are written as zstd, and a query that is written removes its shuffle files at its end,
    not when the driver's garbage is next collected."""
    conf = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session (set one only if unset)."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            d = tempfile.mkdtemp(prefix="polyscore-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared scratch folder."""
    base = scratch_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def _file_system(spark: SparkSession, path: str):
    """The session's Hadoop file system of a path, and the path as its own type."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the session."""
    fs, jpath = _file_system(spark, path)
    return bool(fs.exists(jpath))


def create_exclusive(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless there is one; of several callers one gets True.

    Needs a file system with an atomic create, as HDFS and local disks have.
    """
    from py4j.protocol import Py4JJavaError
    fs, jpath = _file_system(spark, path)
    fs.mkdirs(jpath.getParent())
    if fs.getUri().getScheme() == "file":  # Hadoop's own local create looks first and then writes
        return bool(spark.sparkContext._jvm.java.io.File(jpath.toUri().getPath()).createNewFile())
    try:
        fs.create(jpath, False).close()
    except Py4JJavaError as e:
        if fs.exists(jpath):
            return False
        raise e
    return True


def make_folder(spark: SparkSession, path: str) -> None:
    fs, jpath = _file_system(spark, path)
    fs.mkdirs(jpath)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the library's own that no later step reads."""
    fs, jpath = _file_system(spark, path)
    fs.delete(jpath, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a finished folder to a name that isn't taken."""
    fs, jsource = _file_system(spark, source)
    _, jtarget = _file_system(spark, target)
    if fs.exists(jtarget) or not fs.rename(jsource, jtarget):
        raise FileExistsError(target)


def file_ages(spark: SparkSession, folder: str) -> dict[str, float]:
    """Names in a folder and the seconds since each was changed."""
    import time
    if not path_exists(spark, folder):
        return {}
    fs, jpath = _file_system(spark, folder)
    return {f.getPath().getName(): time.time() - f.getModificationTime() / 1000 for f in fs.listStatus(jpath)}


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``polyscore`` importable by the Python workers (once per application).

    Arrow UDFs reference module-level helpers, so workers must import the
    package; it is zipped and added with ``addPyFile``, which Spark
    distributes to every executor (as ``--py-files`` would).
    """
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = scratch_dir(spark)
    local_base = local_path(base) if (base.startswith("file:") or "://" not in base) else tempfile.mkdtemp()
    os.makedirs(local_base, exist_ok=True)
    dest = os.path.join(local_base, f"polyscore-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(dest, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(dest)
    _SHIPPED.add(key)
