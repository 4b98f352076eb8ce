"""Session defaults and the shared working folder for intermediate tables."""

from __future__ import annotations

import atexit
import gc
import re
import shutil
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Only behaviour that every job here relies on. Sizing (executors, memory,
# shuffle partitions) belongs to whoever submits the job; AQE coalesces a
# generous partition count down to the data.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Recording the Python call site of every column operation more than doubles
    # the time it takes to describe a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName("zonewright")
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="zonewright-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``.

    Only a local-mode session may go without it; there one machine is the whole
    cluster, so a temporary folder is as shared as it gets.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


# Names that scratch_path gives.
_STORED = re.compile(r"-[0-9a-f]{32}$")

# The folder of the run that is going on, if one was begun.
_run: ContextVar[str | None] = ContextVar("run", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, within the run's own folder if there is a run."""
    folder = _run.get() or shared_folder(spark).rstrip("/")
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """A folder for what a job stores on its way; dropped at the end, also after a failure.

    For jobs that write their results: what they return lazily must not read from it.
    """
    folder = scratch_path(spark, "run")
    token = _run.set(folder)
    try:
        yield folder
    finally:
        _run.reset(token)
        _delete(spark, folder)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the
    planner the true size of the result, so whether a later join broadcasts it
    is decided by ``spark.sql.autoBroadcastJoinThreshold`` on a measured size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    _lease(stored, path)
    return stored


# -- the life of stored tables --------------------------------------------------

# (session's context, what the plans that read a stored table share, its folder)
_leases: list[tuple[str, object, str]] = []


def _lease(stored: DataFrame, path: str) -> None:
    """Remembers a stored table for as long as a plan reads it.

    All plans made of a table share its file index. A weak reference to that in the JVM is empty when the last of
    them is gone: a running query holds its plan, and so does a DataFrame that somebody still has.
    """
    spark = stored.sparkSession
    index = stored._jdf.queryExecution().analyzed().relation().location()
    _leases.append((spark.sparkContext.applicationId, spark._jvm.java.lang.ref.WeakReference(index), path))


def release_unread(spark: SparkSession) -> list[str]:
    """Drops what was stored on the way to results that nobody can read any more; returns the folders.

    For services that keep a session and hand out lazy results: call it between requests. Plans are
    found gone when both garbage collectors have seen it, so both run here, more than once, as one passes on to the
    other what it has let go; what they miss goes with the next call. An RDD made of
    a DataFrame doesn't hold its plan: keep the DataFrame as long as the RDD is used.
    """
    for _ in range(3):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.1)
    own = spark.sparkContext.applicationId
    unread = [lease for lease in _leases if lease[0] == own and lease[1].get() is None]
    for lease in unread:
        _leases.remove(lease)
        _delete(spark, lease[2])
    _leases[:] = [lease for lease in _leases if lease[0] == own]  # an ended session's can't be asked any more
    return [path for _, _, path in unread]


def sweep(spark: SparkSession, hours: float) -> list[str]:
    """Drops what any session stored in the shared folder and nobody has written to for so many hours; returns the names.

    For sessions that ended without cleaning up. What this session has stored is left to
    :func:`release_unread`, so ``hours`` has to be longer than other sessions keep their results.
    """
    root = shared_folder(spark).rstrip("/")
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    held = {path.rsplit("/", 1)[-1] for _, _, path in _leases}
    limit = time.time() - hours * 3600
    dropped = []
    for status in files.listStatus(folder) if files.exists(folder) else []:
        name = status.getPath().getName()
        if _STORED.search(name) and name not in held and status.getModificationTime() / 1000 < limit:
            files.delete(status.getPath(), True)
            dropped.append(name)
    return sorted(dropped)
