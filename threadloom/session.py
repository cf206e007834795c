"""Session settings and the places and sizes a job takes from its session."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# A reducer sorts and exchanges with spilling, so it may be large; a driver can hold the block
# lists of so many reducers. Both change the plan only.
SHUFFLE_PARTITION_BYTES = 1024**3
MAX_SHUFFLE_PARTITIONS = 20_000

# Wall-clock times never depend on the session zone, which is pinned anyway; adaptive execution
# merges small shuffle partitions and splits skewed join partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "threadloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the package's settings; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_job_folder: ContextVar[str | None] = ContextVar("job_folder", default=None)


def _shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; without one, a folder in the
    warehouse, which a session's machines share too."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{shared.rstrip('/')}/threadloom"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new directory name for intermediate tables, in the job's folder if a job is running."""
    return f"{_job_folder.get() or _shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def job_folder(spark: SparkSession):
    """Put the enclosed work's intermediate tables into one folder and remove it at the end."""
    folder = f"{_shared_folder(spark)}/job-{uuid.uuid4().hex}"
    token = _job_folder.set(folder)
    try:
        yield folder
    finally:
        _job_folder.reset(token)
        system, path = file_system(spark, folder)
        system.delete(path, True)


def file_system(spark: SparkSession, path: str) -> tuple:
    """The store a path is in, and the path, for renaming and removing; reads and writes of data
    go through DataFrames."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes stored below the paths, from file listings alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return files.agg(F.sum("length")).first()[0] or 0


@contextmanager
def unsorted_writes(spark: SparkSession, files: int = 2):
    """Let a task keep ``files`` output files open, for the enclosed writes into as many partitions;
    else Spark sorts whole rows by the partition first."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(int(before), files)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Let Spark remove the shuffle files of each enclosed action when it ends; else they stay until
    the driver happens to collect its garbage. No DataFrame should be run twice inside."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def sized_shuffle(spark: SparkSession, nbytes: int):
    """Raise the number of shuffle partitions, for the enclosed actions, to fit the data, up to
    :data:`MAX_SHUFFLE_PARTITIONS`.

    Never lowers the session's own number: adaptive execution merges partitions that turn out
    small, but cannot split a plain aggregation's.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    wanted = min(MAX_SHUFFLE_PARTITIONS, -(-nbytes // SHUFFLE_PARTITION_BYTES))
    spark.conf.set(key, str(max(int(before), wanted)))
    try:
        yield
    finally:
        spark.conf.set(key, before)
