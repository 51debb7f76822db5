"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans are written for.  All of them are SQL settings, so
# they can also be applied to a session somebody else created.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even when that costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # a longer method is never compiled by the JVM: its operators then have code of their own, in shorter ones
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Rows with whole texts go to Python tasks in batches of about so many bytes (Spark's own bound is 64 MB).
# A batch lies in the JVM's buffers and in the worker's at once, beside a heap that is never given back.
BATCH_BYTES = "4m"


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def small_batches(spark: SparkSession) -> None:
    """From now on the session's Python tasks take their rows in batches of ``BATCH_BYTES``."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def local_session(cores: int | str = "*", name: str = "ledgerloom") -> SparkSession:
    """A local session for tests and the benchmark."""
    partitions = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is only taken in local mode, where driver and
    executors are the same process.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    one_machine = context.master.startswith("local")
    if named:
        return named.rstrip("/")
    if not one_machine:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    own = tempfile.mkdtemp(prefix="ledgerloom-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    context.setCheckpointDir(own)
    return context.getCheckpointDir().rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below this application's part of the shared folder."""
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/ledgerloom/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.delete(folder, True)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what it holds; nothing happens if there is none."""
    _delete(spark, path)
    spark.catalog.refreshByPath(path)


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Let ``new`` take the place of ``path``; the old folder goes last.

    If the switch fails, the old folder is back in its place and ``new`` is kept.
    """
    jvm = spark.sparkContext._jvm
    target, fresh = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(new)
    aside = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}__old_{uuid.uuid4().hex}")
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.rename(target, aside):
        raise RuntimeError(f"{path} cannot be moved; the new state is in {new}")
    if not files.rename(fresh, target):
        files.rename(aside, target)
        raise RuntimeError(f"{new} cannot be moved to {path}, which is as before")
    spark.catalog.refreshByPath(path)
    files.delete(aside, True)


def drop_intermediates(spark: SparkSession) -> bool:
    """Remove what ``materialize`` wrote for this application.

    To be called when nothing that was read from there is needed any more.
    """
    return _delete(spark, _application_folder(spark))


@contextmanager
def open_writers(spark: SparkSession, count: int) -> Iterator[None]:
    """Writes of the block keep up to ``count`` files open in a task.

    Rows that are written by a column of so few values need not be sorted by it first, which
    would hold all rows of a task.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(count))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables of a block when it ends.

    For blocks that write their result: lazy results of the block that are
    still to be read would lose their tables.
    """
    opened: list[str] = []
    token = _scratch.set(opened)
    try:
        yield
    finally:
        _scratch.reset(token)
    for path in opened:  # kept if the block failed: they may be the only copy of its result
        _delete(spark, path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    The lineage ends at the written files, so a lost executor repeats a scan,
    not the work before it; the files also give the planner true sizes, on
    which it decides between broadcast and shuffle joins.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    if (opened := _scratch.get()) is not None:
        opened.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """Store what ``make`` returns, and remove the intermediate tables that led to it.

    For a small result of a long way: what comes after needs none of those tables any more.
    """
    path = fresh_folder(spark, label)
    with scratch(spark):
        result = make()
        result.write.parquet(path)
    if (opened := _scratch.get()) is not None:
        opened.append(path)
    return spark.read.schema(result.schema).parquet(path)
