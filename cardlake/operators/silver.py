"""Silver: typed, cleaned transactions, and a quarantine for rows that break a rule."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cardlake import contracts
from cardlake.functions import columns as C
from cardlake.operators.rows import one_row
from cardlake.session import small_scans
from cardlake.sources import tables

BRONZE_REQUIRED = (
    *contracts.TRANSACTIONS.fieldNames(),
    "_source_file_name",
    "_ingestion_timestamp_utc",
    "_pipeline_run_id",
)

# Published column order of the two tables.
SILVER_COLUMNS = (
    "user_id", "card_id", "transaction_timestamp", "transaction_amount",
    "transaction_method", "merchant_id", "merchant_city", "merchant_state",
    "merchant_zip_code", "merchant_category_code", "transaction_error", "is_fraud",
    "_source_file_name", "_ingestion_timestamp_utc", "_pipeline_run_id",
    "_silver_processed_at_utc",
)
QUARANTINE_COLUMNS = (
    "user_id", "card_id", "transaction_year", "transaction_month", "transaction_day",
    "transaction_time", "transaction_timestamp", "transaction_amount_raw",
    "transaction_amount", "transaction_method", "merchant_id", "merchant_city",
    "merchant_state", "merchant_zip_code_raw", "merchant_zip_code",
    "merchant_category_code", "transaction_error", "is_fraud_raw", "is_fraud",
    "quarantine_reason", "_source_file_name", "_ingestion_timestamp_utc",
    "_pipeline_run_id", "_silver_processed_at_utc",
)

# Raw inputs are kept for quarantined rows only.
_RAW_COLUMNS = (
    "transaction_year", "transaction_month", "transaction_day", "transaction_time",
    "transaction_amount_raw", "merchant_zip_code_raw", "is_fraud_raw",
)

STATUS = "record_status"
VALID, QUARANTINED = "valid", "quarantine"


def quarantine_reason() -> Column:
    """All broken rules of a row in rule order, joined by ``;``; empty when valid."""
    rules = (
        ("user_id", "MISSING_USER_ID"),
        ("card_id", "MISSING_CARD_ID"),
        ("transaction_amount", "INVALID_AMOUNT"),
        ("transaction_timestamp", "INVALID_TRANSACTION_TIMESTAMP"),
        ("is_fraud", "INVALID_FRAUD_FLAG"),
    )
    return F.concat_ws(";", *[F.when(F.col(name).isNull(), code) for name, code in rules])


def clean_transactions(bronze: DataFrame, processed_at: datetime | Column) -> DataFrame:
    """Every bronze row, renamed, typed, cleaned and tagged with its reason.

    One projection over the scan: no shuffle, no Python.
    """
    contracts.require_columns(bronze, BRONZE_REQUIRED, "Bronze transactions")
    types = {field.name: field.dataType for field in bronze.schema}
    stamp = processed_at if isinstance(processed_at, Column) else F.lit(processed_at)

    def number(name: str) -> Column:
        return C.parse_int64(F.col(f"`{name}`"), types[name])

    lineage = [name for name in contracts.LINEAGE.fieldNames() if name in types]
    cleaned = bronze.select(
        number("User").alias("user_id"),
        number("Card").alias("card_id"),
        F.col("Year").alias("transaction_year"),
        F.col("Month").alias("transaction_month"),
        F.col("Day").alias("transaction_day"),
        F.col("Time").alias("transaction_time"),
        C.assemble_timestamp(
            F.col("Year"), F.col("Month"), F.col("Day"), F.col("Time")
        ).alias("transaction_timestamp"),
        F.col("Amount").alias("transaction_amount_raw"),
        C.parse_money(F.col("Amount")).alias("transaction_amount"),
        C.method_code(F.col("`Use Chip`")).alias("transaction_method"),
        number("Merchant Name").alias("merchant_id"),
        C.strip_text(F.col("`Merchant City`")).alias("merchant_city"),
        C.strip_text(F.col("`Merchant State`")).alias("merchant_state"),
        F.col("Zip").alias("merchant_zip_code_raw"),
        C.zip_text(F.col("Zip"), types["Zip"]).alias("merchant_zip_code"),
        number("MCC").alias("merchant_category_code"),
        C.error_text(F.col("`Errors?`")).alias("transaction_error"),
        F.col("`Is Fraud?`").alias("is_fraud_raw"),
        C.fraud_flag(F.col("`Is Fraud?`")).alias("is_fraud"),
        "_source_file_name",
        "_ingestion_timestamp_utc",
        "_pipeline_run_id",
        stamp.cast("timestamp").alias("_silver_processed_at_utc"),
        *lineage,
    )
    return cleaned.withColumn("quarantine_reason", quarantine_reason())


# Where a stored row lies: its file and its place there, counted from 0.
POSITION = ("_silver_file", "_silver_row")


def silver_rows(cleaned: DataFrame) -> DataFrame:
    """Rows without a reason, in the published columns plus lineage where present."""
    lineage = [name for name in contracts.LINEAGE.fieldNames() if name in cleaned.columns]
    return cleaned.where(F.col("quarantine_reason") == "").select(*SILVER_COLUMNS, *lineage)


def quarantine_rows(cleaned: DataFrame) -> DataFrame:
    return cleaned.where(F.col("quarantine_reason") != "").select(*QUARANTINE_COLUMNS)


def write_silver(cleaned: DataFrame, path: str) -> None:
    """Write valid and quarantined rows in one pass over the source.

    Both tables share one dataset partitioned by record status, so the source is
    read and parsed once and nothing is cached. Raw inputs are blanked on valid
    rows, where they are not part of the published table.

    Rows with lineage are written in its order within each file, and a note beside the
    table says so: gold then numbers them by their places in the files.
    """
    broken = F.col("quarantine_reason") != ""
    lineage = [name for name in contracts.LINEAGE.fieldNames() if name in cleaned.columns]
    rows = cleaned.withColumns({
        name: F.when(broken, F.col(name)) for name in _RAW_COLUMNS
    }).withColumn(STATUS, F.when(broken, QUARANTINED).otherwise(VALID))
    if lineage:
        rows = rows.sortWithinPartitions(STATUS, *lineage)
    spark = cleaned.sparkSession
    with small_scans(spark):
        tables.overwrite(rows, path, (STATUS,))
    stamp = tables.content_stamp(spark, path) if len(lineage) == len(contracts.LINEAGE) else ""
    spark.createDataFrame([(stamp,)], "stamp string").coalesce(1).write.mode("overwrite").parquet(_order_path(path))


def _order_path(path: str) -> str:
    return f"{path.rstrip('/')}_order"


def is_ordered(spark: SparkSession, path: str) -> bool:
    """Whether the rows of every file are in the order of their lineage, as last written."""
    if not tables.exists(spark, _order_path(path)):
        return False
    noted = spark.read.parquet(_order_path(path)).first()
    return noted is not None and noted["stamp"] == tables.content_stamp(spark, path)


def _read_status(
    spark: SparkSession, path: str, status: str, schema: T.StructType | None
) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(T.StructType([*schema, T.StructField(STATUS, T.StringType())]))
    # The status filter prunes to one directory before any file is opened.
    return reader.parquet(path).where(F.col(STATUS) == status).drop(STATUS)


def read_silver(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Valid rows; ``schema`` (of the cleaned rows) allows reading an empty table."""
    return silver_rows(_read_status(spark, path, VALID, schema))


def read_positioned(spark: SparkSession, path: str) -> DataFrame:
    """Valid rows with the file and the place in it where each is stored, if files are ordered."""
    if not is_ordered(spark, path):
        return read_silver(spark, path)
    stored = spark.read.parquet(path)
    rows = stored.where(F.col(STATUS) == VALID).select(
        *[F.col(name) for name in stored.columns if name != STATUS],
        F.col("_metadata.file_name").alias(POSITION[0]), F.col("_metadata.row_index").alias(POSITION[1]))
    lineage = [name for name in contracts.LINEAGE.fieldNames() if name in stored.columns]
    return rows.where(F.col("quarantine_reason") == "").select(*SILVER_COLUMNS, *lineage, *POSITION)


def read_quarantine(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    return quarantine_rows(_read_status(spark, path, QUARANTINED, schema))


def reconcile(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """One row: rows read, rows in each output, and whether they add up."""
    row = one_row(
        bronze.agg(F.count(F.lit(1)).alias("bronze_rows_read")),
        silver.agg(F.count(F.lit(1)).alias("silver_rows_written")),
        quarantine.agg(F.count(F.lit(1)).alias("quarantine_rows_written")),
    )
    written = F.col("silver_rows_written") + F.col("quarantine_rows_written")
    return row.withColumn("reconciliation_passed", F.col("bronze_rows_read") == written)


def build_silver(
    spark: SparkSession, bronze_path: str, silver_path: str, processed_at: datetime
) -> dict:
    """Bronze table -> silver and quarantine tables, with row reconciliation."""
    tables.require_paths(spark, {"Bronze transactions": bronze_path}, "The silver layer")
    bronze = spark.read.parquet(bronze_path)
    cleaned = clean_transactions(bronze, processed_at)
    write_silver(cleaned, silver_path)
    counts = reconcile(
        bronze,
        read_silver(spark, silver_path, cleaned.schema),
        read_quarantine(spark, silver_path, cleaned.schema),
    ).first()
    return {"status": "SUCCESS", **counts.asDict(), "silver_output_path": silver_path}
