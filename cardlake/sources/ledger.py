"""The ingest ledger: one row per processing attempt of a landing file.

Beside it lies the table of sequence numbers. Numbers are taken there before any row that
carries them is written, so a number never stands for two files, whatever happens between
the write and the ledger entry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from cardlake.sources import tables

# Ledger columns in order.
SCHEMA = T.StructType([
    T.StructField("source_file_name", T.StringType()),
    T.StructField("source_file_size_bytes", T.LongType()),
    T.StructField("source_file_sha256", T.StringType()),
    T.StructField("pipeline_run_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("rows_written", T.LongType()),
    T.StructField("processed_at_utc", T.TimestampType()),
    T.StructField("error_message", T.StringType()),
])
SUCCESS, FAILED, SKIPPED = "SUCCESS", "FAILED", "SKIPPED"

# A batch takes numbers for its files, one row each, and adds a row when it is done.
NUMBERS = T.StructType([
    T.StructField("batch", T.StringType()),
    T.StructField("source_file_sha256", T.StringType()),
    T.StructField("sequence", T.LongType()),
    T.StructField("done", T.BooleanType()),
])


def normalize(df: DataFrame) -> DataFrame:
    """Bring a ledger of any age to today's columns, types and order."""
    present = set(df.columns)
    return df.select(*[
        (F.col(field.name) if field.name in present else F.lit(None))
        .cast(field.dataType).alias(field.name)
        for field in SCHEMA
    ])


def load(spark: SparkSession, path: str) -> DataFrame:
    if not tables.exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return normalize(spark.read.option("mergeSchema", True).parquet(path))


def append(spark: SparkSession, path: str, records: DataFrame) -> None:
    normalize(records).coalesce(1).write.mode("append").parquet(path)


def _numbers_path(path: str) -> str:
    return f"{path.rstrip('/')}_numbers"


def numbers(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_or_empty(spark, _numbers_path(path), NUMBERS)


def reserve(spark: SparkSession, path: str, batch: str, accepted: DataFrame) -> None:
    """Take numbers for the files of a batch: (name, path, source_file_sha256) rows.

    Content that has a number keeps it. Others are numbered on, in order of name, from the
    highest number ever taken; before there were numbers, from the number of good files. The
    window holds one narrow row per new file.
    """
    taken = numbers(spark, path)
    known = taken.where("sequence IS NOT NULL").select("source_file_sha256").distinct()
    highest = taken.agg(F.max("sequence")).first()[0]
    good = load(spark, path).where(F.col("status") == SUCCESS).count()
    first = max(good, 0 if highest is None else highest + 1)
    order = Window.orderBy(F.lower("name"), "name", "path")
    accepted.join(known, "source_file_sha256", "left_anti").select(
        F.lit(batch).alias("batch"), "source_file_sha256",
        (F.row_number().over(order) - 1 + first).cast("bigint").alias("sequence"),
        F.lit(False).alias("done"),
    ).coalesce(1).write.mode("append").parquet(_numbers_path(path))


def finish(spark: SparkSession, path: str, batch: str) -> None:
    """Note that the rows of a batch and its ledger entries are both stored."""
    spark.createDataFrame([(batch, None, None, True)], NUMBERS).coalesce(1).write.mode(
        "append").parquet(_numbers_path(path))


def unfinished(spark: SparkSession, path: str) -> DataFrame:
    """Content whose batch broke off before its ledger entry.

    A batch that was finished stays so when its ledger is lost.
    """
    taken = numbers(spark, path)
    done = taken.where("done").select("batch").distinct()
    good = load(spark, path).where(F.col("status") == SUCCESS).select("source_file_sha256").distinct()
    return (
        taken.where("NOT done").join(done, "batch", "left_anti")
        .select("source_file_sha256").distinct().join(good, "source_file_sha256", "left_anti")
    )


def mark_processed(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Add ``already_processed`` to (name, size, sha256) rows.

    Content decides: a renamed copy is known, changed content under an old name is
    not. Ledger rows from before hashing have no hash and match on name and size.
    """
    done = ledger.where(F.col("status") == SUCCESS)
    digest = F.trim(F.coalesce("source_file_sha256", F.lit("")))
    by_hash = (
        done.where(digest != "")
        .select(F.col("source_file_sha256").alias("sha256")).distinct()
        .withColumn("_by_hash", F.lit(True))
    )
    by_name = (
        done.where(digest == "")
        .select(
            F.col("source_file_name").alias("name"), F.col("source_file_size_bytes").alias("size")
        ).distinct()
        .withColumn("_by_name", F.lit(True))
    )
    known = F.coalesce("_by_hash", "_by_name", F.lit(False))
    return (
        files.join(by_hash, "sha256", "left").join(by_name, ["name", "size"], "left")
        .withColumn("already_processed", known).drop("_by_hash", "_by_name")
    )
