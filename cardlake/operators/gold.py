"""Gold: a star schema of one transaction fact with a merchant and a date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardlake import contracts
from cardlake.functions import columns as C
from cardlake.operators import keys, lookup, quality, silver
from cardlake.session import small_shuffles, staged_tables
from cardlake.sources import tables

SILVER_REQUIRED = silver.SILVER_COLUMNS[:12]

MERCHANT_COLUMNS = (
    "merchant_id", "merchant_city", "merchant_state", "merchant_zip_code",
    "merchant_category_code",
)

# Published column order of the fact.
FACT_COLUMNS = (
    "transaction_key", "date_key", "merchant_key", "user_id", "card_id",
    "transaction_timestamp", "transaction_amount", "transaction_method",
    "merchant_category_code", "transaction_error", "is_fraud",
    "_source_file_name", "_ingestion_timestamp_utc", "_pipeline_run_id",
)

# Sums of the fact that its controls keep.
FACT_TOTALS = ("transaction_amount_total", "fraud_transaction_count", "error_transaction_count")
_STAMPS = ("merchant_stamp", "date_stamp", "fact_stamp")

# Directory column of the fact: lets a year filter skip whole directories.
FACT_YEAR = "fact_year"

# The fact's order in its files, and how much of it shares one set of statistics.
CLUSTERING = (FACT_YEAR, "merchant_key", "transaction_key")
ROW_GROUP_BYTES = 16 * 1024 * 1024

_WEIGHT = "_transactions"


def merchant_index(silver_df: DataFrame) -> DataFrame:
    """The merchant dimension plus the number of transactions of each merchant.

    Counting while removing duplicates costs the same single shuffle, combines rows
    before it, and tells the fact build which merchants are hot.
    """
    contracts.require_columns(silver_df, SILVER_REQUIRED, "Silver transactions")
    merchants = silver_df.groupBy(*MERCHANT_COLUMNS).agg(F.count(F.lit(1)).alias(_WEIGHT))
    order = [F.col(name).asc_nulls_last() for name in MERCHANT_COLUMNS]
    return keys.dense_key(merchants, order, "merchant_key")


def create_merchant_dimension(silver_df: DataFrame) -> DataFrame:
    """One row per distinct merchant record, numbered 1..n in sort order."""
    return merchant_index(silver_df).drop(_WEIGHT)


def create_date_dimension(silver_df: DataFrame) -> DataFrame:
    """One row per calendar day from the first to the last transaction, gaps included."""
    stamp = F.col("transaction_timestamp")
    span = silver_df.agg(
        F.min(stamp).cast("date").alias("first"),
        F.max(stamp).cast("date").alias("last"),
        C.count_where(stamp.isNull()).alias("invalid"),
    ).first()
    if span["invalid"]:
        raise ValueError(
            f"Date dimension cannot be created: {span['invalid']} timestamps are invalid"
        )
    if span["first"] is None:
        raise ValueError("Date dimension cannot be created from an empty date range")
    days = silver_df.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(span["first"]), F.lit(span["last"]))).alias("full_date")
    )
    day = F.col("full_date")
    return days.select(
        C.date_key(day).alias("date_key"),
        day,
        F.year(day).cast("bigint").alias("calendar_year"),
        F.quarter(day).cast("bigint").alias("calendar_quarter"),
        F.month(day).cast("bigint").alias("calendar_month_number"),
        F.date_format(day, "MMMM").alias("calendar_month_name"),
        F.dayofmonth(day).cast("bigint").alias("calendar_day_of_month"),
        (F.weekday(day) + 1).cast("bigint").alias("calendar_day_of_week_number"),
        F.date_format(day, "EEEE").alias("calendar_day_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )


def create_transaction_fact(silver_df: DataFrame, merchants: DataFrame) -> DataFrame:
    """One row per silver transaction with its date, merchant and transaction keys.

    ``merchants`` is a merchant dimension, best one from ``merchant_index``: without
    its transaction counts they are computed here first.
    """
    if _WEIGHT not in merchants.columns:
        _require_unique_merchants(merchants)
        weights = silver_df.groupBy(*MERCHANT_COLUMNS).agg(F.count(F.lit(1)).alias(_WEIGHT))
        merchants = lookup.attach(
            merchants, weights.withColumn("_one", F.lit(1)), list(MERCHANT_COLUMNS),
            [_WEIGHT], weight="_one",
        ).fillna(0, [_WEIGHT])
    keyed = lookup.attach(
        silver_df, merchants, list(MERCHANT_COLUMNS), ["merchant_key"], weight=_WEIGHT
    ).withColumn("date_key", C.date_key(F.col("transaction_timestamp")))

    lineage = contracts.LINEAGE.fieldNames()
    if set(lineage) <= set(silver_df.columns):
        numbered = None
        if set(silver.POSITION) <= set(silver_df.columns):
            numbered = keys.position_key(
                keyed, silver_df, lineage[:2], lineage[2], *silver.POSITION, "transaction_key")
        if numbered is None:
            numbered = keys.sequence_key(
                keyed, lineage[:2], lineage[2], "transaction_key", population=silver_df
            )
    else:
        # Copies of a row are told apart, so that they spread over partitions.
        order = [F.col(name).asc_nulls_last() for name in (*silver_df.columns, "_copy")]
        numbered = keys.dense_key(
            keyed.withColumn("_copy", F.monotonically_increasing_id()), order, "transaction_key"
        )
    return numbered.select([name for name in FACT_COLUMNS if name in numbered.columns])


def _require_unique_merchants(merchants: DataFrame) -> None:
    repeated = merchants.groupBy(*MERCHANT_COLUMNS).count().where("count > 1")
    if not repeated.isEmpty():
        raise ValueError("Merchant dimension holds more than one row for the same merchant")


def write_fact(fact: DataFrame, path: str, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Write the fact in year directories, clustered by merchant, with files of even size.

    Rows are dealt out by ranges of (year, merchant, key). A file therefore holds few
    merchants of one year, or a part of one large merchant, and its statistics let a
    drill-through to one merchant skip all other files, and row groups within its own.
    """
    year = F.floor(F.col("date_key") / 10000).cast("int")
    clustered = fact.withColumn(FACT_YEAR, year).repartitionByRange(*CLUSTERING)
    tables.overwrite(clustered.sortWithinPartitions(*CLUSTERING), path, (FACT_YEAR,), row_group_bytes)


def write_gold(
    silver_df: DataFrame, merchant_path: str, date_path: str, fact_path: str
) -> None:
    """Write the three tables; the merchant index is computed once for two of them."""
    with staged_tables(silver_df.sparkSession):
        index = merchant_index(silver_df)
        tables.overwrite(index.drop(_WEIGHT), merchant_path)
        tables.overwrite(create_date_dimension(silver_df), date_path)
        write_fact(create_transaction_fact(silver_df, index), fact_path)


def build_gold(
    spark: SparkSession, silver_path: str, merchant_path: str, date_path: str, fact_path: str
) -> dict:
    """Silver table -> three gold tables, written and then validated as written.

    The tables are checked after writing, from storage: that proves what readers
    will see and avoids computing the model a second time.
    """
    tables.require_paths(spark, {"Silver transactions": silver_path}, "The gold model")
    silver_df = silver.read_positioned(spark, silver_path)
    with small_shuffles(spark, tables.stored_bytes(spark, silver_path)):
        write_gold(silver_df, merchant_path, date_path, fact_path)

        merchants = spark.read.parquet(merchant_path)
        dates = spark.read.parquet(date_path)
        fact = read_fact(spark, fact_path)
        controls = write_controls(spark, merchant_path, date_path, fact_path)
        expected = silver_df.agg(F.count(F.lit(1)).alias("expected_fact_rows"))
        validation = quality.require_valid(
            quality.with_verdict(controls.drop(*FACT_TOTALS), expected).first().asDict(), "Gold model")
    return {
        "status": "SUCCESS",
        "silver_rows_read": validation["expected_fact_rows"],
        "merchant_rows_written": validation["merchant_rows"],
        "date_rows_written": validation["date_rows"],
        "transaction_rows_written": validation["actual_fact_rows"],
        "merchant_columns": len(merchants.columns),
        "date_columns": len(dates.columns),
        "transaction_columns": len(fact.drop(FACT_YEAR).columns),
        "persisted_validation": validation,
    }


def fact_totals() -> dict[str, Column]:
    """Columns of the fact whose sums are kept with its controls."""
    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("bigint")

    values = (
        C.money(F.col("transaction_amount")), flag(F.col("is_fraud")),
        flag(C.has_error(F.col("transaction_error"))),
    )
    return dict(zip(FACT_TOTALS, values))


def _controls_path(fact_path: str) -> str:
    return f"{fact_path.rstrip('/')}_controls"


def write_controls(
    spark: SparkSession, merchant_path: str, date_path: str, fact_path: str
) -> DataFrame:
    """Compute the controls and totals of the stored model once and keep them beside the fact."""
    controls = quality.star_controls(
        spark.read.parquet(merchant_path), spark.read.parquet(date_path),
        read_fact(spark, fact_path), fact_totals(),
    )
    stamps = {
        name: F.lit(tables.content_stamp(spark, path))
        for name, path in zip(_STAMPS, (merchant_path, date_path, fact_path))
    }
    tables.overwrite(controls.withColumns(stamps), _controls_path(fact_path))
    return spark.read.parquet(_controls_path(fact_path)).drop(*_STAMPS)


def stored_controls(
    spark: SparkSession, merchant_path: str, date_path: str, fact_path: str
) -> DataFrame | None:
    """The kept controls, or none where a table has been written again since."""
    if not tables.exists(spark, _controls_path(fact_path)):
        return None
    kept = spark.read.parquet(_controls_path(fact_path))
    row = kept.select(*_STAMPS).first()
    now = tuple(tables.content_stamp(spark, path) for path in (merchant_path, date_path, fact_path))
    return kept.drop(*_STAMPS) if row is not None and tuple(row) == now else None


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """The fact with its directory column, which year filters use for pruning."""
    return spark.read.parquet(path)
