"""Spark session helpers: a local session, the shared folder and staged tables."""

from __future__ import annotations

import math
import re
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", app_name: str = "cardlake") -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Directory-partitioned writes keep a few files open instead of sorting first.
        .config("spark.sql.maxConcurrentOutputFileWriters", "32")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of its own: on a cluster
    a machine-local folder would be lost with its machine, so it is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError(
            "spark.checkpoint.dir must name a shared folder when running on a cluster"
        )
    application = context.applicationId
    if application not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="cardlake-")
    return _LOCAL_ROOTS[application]


# Paths handed out inside each open ``staged_tables`` block, the innermost last.
_OWNERS: list[list[str]] = []


def staging_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A path no other run uses, below the shared folder.

    It belongs to the innermost ``staged_tables`` block, with ``keep`` to the one around it.
    """
    application = spark.sparkContext.applicationId
    path = f"{shared_root(spark)}/cardlake/{application}/{name}-{uuid.uuid4().hex}"
    owners = _OWNERS[:-1] if keep else _OWNERS
    if owners:
        owners[-1].append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


@contextmanager
def staged_tables(spark: SparkSession) -> Iterator[None]:
    """Own the tables staged inside the block and drop them at its end.

    Results that read them must have been written or collected by then. Blocks may be nested;
    each drops its own. Tables staged outside any block stay until ``expire_staged``.
    """
    own: list[str] = []
    _OWNERS.append(own)
    try:
        yield
    finally:
        _OWNERS.remove(own)
        for path in own:
            _delete(spark, path)


def expire_staged(spark: SparkSession, days: float = 7.0) -> int:
    """Drop what other applications staged and have not touched for so many days.

    Returns the number of applications whose folder was dropped. A folder counts by its
    latest entry, so an application that still stages tables keeps its own.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/cardlake")
    file_system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not file_system.exists(root):
        return 0
    oldest = (time.time() - days * 86_400) * 1000
    dropped = 0
    for application in file_system.listStatus(root):
        latest = [application.getModificationTime()]
        if application.isDirectory():
            latest += [entry.getModificationTime() for entry in file_system.listStatus(application.getPath())]
        name = application.getPath().getName()
        if name != spark.sparkContext.applicationId and max(latest) < oldest:
            dropped += bool(file_system.delete(application.getPath(), True))
    return dropped


def stage(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts lineage the durable way: later reads see exactly the rows written,
    whichever executors have been lost since. ``keep`` as in ``staging_path``.
    """
    spark = df.sparkSession
    path = staging_path(spark, name, keep)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# A shuffle partition should hold about this much, and stored columns grow by about
# this factor when their rows are shuffled. More partitions than the limit cost more
# in bookkeeping than they save.
SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024
SHUFFLE_GROWTH = 4
MAX_SHUFFLE_PARTITIONS = 100_000

# Where rows are grouped or sorted as a whole, partitions hold this much: rows take a task
# up to ten times as much memory as they take in the shuffle.
GROUPED_PARTITION_BYTES = 16 * 1024 * 1024


# Adaptive execution merges partitions up to this much. Keys with their counts shrink to a
# few bytes each in the shuffle, so merged partitions of the usual 64 MB hold millions of them.
MERGED_PARTITION_BYTES = 8 * 1024 * 1024


# Stored columns take up to twenty times their bytes as rows, and Spark reads 128 MB of them
# in one task. Sorting or grouping what such a task has read spills; this much does not.
SCAN_BYTES = 16 * 1024 * 1024


@contextmanager
def _configured(spark: SparkSession, name: str, value: int | str | None) -> Iterator[None]:
    """Have a setting for the jobs inside; none leaves it as it is."""
    if value is None:
        yield
        return
    before = spark.conf.get(name)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _at_most(spark: SparkSession, name: str, size: int):
    """Have a setting of bytes no larger than ``size`` for the jobs inside."""
    configured = spark.conf.get(name).lower().removesuffix("b")
    larger = not configured.isdigit() or int(configured) > size
    return _configured(spark, name, size if larger else None)


def short_lived_shuffles(spark: SparkSession):
    """Drop the shuffle files of a job as soon as it has ended, for the jobs inside.

    Spark keeps them until the driver happens to collect its garbage, which a driver with little
    to do may never: the shuffles of all jobs of a build then lie on disk at once. A job that
    reads a shuffle of an earlier one computes it again.
    """
    return _configured(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


@contextmanager
def shuffles_sized_for(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Raise the number of shuffle partitions to suit the input, for the jobs inside.

    Adaptive execution can merge partitions that turn out small but not split a sort
    or an aggregation that has too few of them. A higher configured number is kept.
    It merges them up to ``MERGED_PARTITION_BYTES`` only, so that memory of a task does
    not follow the input. Scans are cut small too, as in ``small_scans``, and shuffles are
    dropped with their job, as in ``short_lived_shuffles``.
    """
    name = "spark.sql.shuffle.partitions"
    configured = spark.conf.get(name)
    wanted = min(
        MAX_SHUFFLE_PARTITIONS,
        math.ceil(input_bytes * SHUFFLE_GROWTH / SHUFFLE_PARTITION_BYTES),
    )
    raised = configured.isdigit() and wanted > int(configured)
    with (
        small_scans(spark), short_lived_shuffles(spark), _configured(spark, name, wanted if raised else None),
        _at_most(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", MERGED_PARTITION_BYTES),
        # Where all partitions of one side are as small as this, neither side is sorted for a join.
        _configured(spark, "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", MERGED_PARTITION_BYTES),
    ):
        yield


def small_shuffles(spark: SparkSession, input_bytes: int):
    """``shuffles_sized_for`` with partitions of ``GROUPED_PARTITION_BYTES``, for the jobs inside."""
    return shuffles_sized_for(spark, input_bytes * SHUFFLE_PARTITION_BYTES // GROUPED_PARTITION_BYTES)


@contextmanager
def small_scans(spark: SparkSession) -> Iterator[None]:
    """Cut scans into pieces whose rows a task can sort or group in memory, for the jobs inside."""
    with _at_most(spark, "spark.sql.files.maxPartitionBytes", SCAN_BYTES):
        yield


@contextmanager
def open_writers(spark: SparkSession, files: int) -> Iterator[None]:
    """Let tasks keep so many files open instead of sorting rows by directory, for the jobs inside."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    with _configured(spark, name, files if int(spark.conf.get(name)) < files else None):
        yield
