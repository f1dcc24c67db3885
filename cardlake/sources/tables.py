"""Parquet tables: existence checks, optional reads, overwrite and append."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, types as T

from cardlake.session import open_writers

# Partitions one task may write at the same time; of more it sorts its rows first.
OPEN_PARTITIONS = 64

# Layers and published versions lie side by side, so their bytes add up.
COMPRESSION = "zstd"


def hadoop_path(spark: SparkSession, path: str):
    """A path object and its file system, for any scheme Spark can read."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path, file_system = hadoop_path(spark, path)
    return file_system.exists(jvm_path)


def is_directory(spark: SparkSession, path: str) -> bool:
    jvm_path, file_system = hadoop_path(spark, path)
    return file_system.exists(jvm_path) and file_system.getFileStatus(jvm_path).isDirectory()


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below a path, from file system metadata."""
    jvm_path, file_system = hadoop_path(spark, path)
    return file_system.getContentSummary(jvm_path).getLength()


def require_paths(spark: SparkSession, inputs: Mapping[str, str], consumer: str) -> None:
    """One error that names every missing input."""
    missing = [f"{name} ({path})" for name, path in inputs.items() if not exists(spark, path)]
    if missing:
        raise FileNotFoundError(
            f"{consumer} cannot be built because inputs are missing: {', '.join(missing)}"
        )


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty one of the same shape before its first write."""
    if exists(spark, path):
        return spark.read.parquet(path)
    return spark.createDataFrame([], schema)


def drop_partition(spark: SparkSession, path: str, partition: str) -> None:
    """Remove one directory (``column=value``) of a partitioned table, if it is there."""
    jvm_path, file_system = hadoop_path(spark, f"{path.rstrip('/')}/{partition}")
    file_system.delete(jvm_path, True)


def overwrite(
    df: DataFrame, path: str, partition_by: tuple[str, ...] = (), row_group_bytes: int | None = None
) -> None:
    """Replace a table; small row groups let filters on a sorted column skip more of a file."""
    writer = df.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(*partition_by)
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def rename(spark: SparkSession, path: str, target: str) -> None:
    jvm_path, file_system = hadoop_path(spark, path)
    if not file_system.rename(jvm_path, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{path} cannot be renamed to {target}")


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Replace one file by a few bytes from the driver."""
    jvm_path, file_system = hadoop_path(spark, path)
    stream = file_system.create(jvm_path, True)
    stream.write(bytearray(content))
    stream.close()


def drop_files_up_to(spark: SparkSession, path: str, names: str, size: int) -> None:
    """Remove files of so few bytes, unless all files of the folder are that small."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{names}")
    file_system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = list(file_system.globStatus(pattern) or [])
    small = [status for status in found if status.getLen() <= size]
    if len(small) < len(found):
        for status in small:
            file_system.delete(status.getPath(), False)


def content_stamp(spark: SparkSession, path: str) -> str:
    """Number of files, bytes and latest change below a path, from file system metadata.

    Any write to the table changes it.
    """
    jvm_path, file_system = hadoop_path(spark, path)
    summary = file_system.getContentSummary(jvm_path)
    # A write ends with the marker file of its commit.
    marker = spark._jvm.org.apache.hadoop.fs.Path(jvm_path, "_SUCCESS")
    done = file_system.getFileStatus(marker if file_system.exists(marker) else jvm_path).getModificationTime()
    return f"{summary.getFileCount()} files, {summary.getLength()} bytes, {done}"


def append_by_partition(df: DataFrame, path: str, partition_by: str) -> None:
    """Add partitions and keep all others.

    A repeated attempt replaces just the partitions it writes again, so a crash
    between the write and its ledger entry cannot duplicate rows.
    """
    with open_writers(df.sparkSession, OPEN_PARTITIONS):
        (
            df.write.mode("overwrite").option("compression", COMPRESSION)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition_by)
            .parquet(path)
        )
