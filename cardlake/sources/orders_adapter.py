"""Shapes the order-and-line-item sample tables like landed card transactions.

The sample has no card data, so each line item stands for one card payment. Some
rows get faults on purpose (no user, bad time, bad amount, bad fraud word) so that
the cleaning and quarantine rules have work to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardlake import contracts

# The order in which the sample's payments "arrive".
_PAYMENT = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    "l_shipdate",
)
# Exact copies of a row follow their place in the source files. That makes the order
# total, so however many copies there are, they spread over partitions.
ARRIVAL_ORDER = (*_PAYMENT, "_copy_file", "_copy_row")

FIRST_MERCHANT_ID = 8_000_000_000_000_000_000
FIRST_ZIP = 10000.0
FIRST_MCC = 5000


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the few columns needed from orders, suppliers and parts.

    Only ``nation`` is broadcast by hint: it has 25 rows at every scale. The other
    sides grow with the data, so their strategy is left to runtime statistics,
    which also split skewed join partitions.
    """
    def read(table: str, *columns: str | Column) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)

    return (
        read(
            "lineitem", *_PAYMENT,
            F.xxhash64("_metadata.file_path").alias("_copy_file"),
            F.col("_metadata.row_index").alias("_copy_row"),
        )
        .join(read("orders", "o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(read("part", "p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
        .join(read("supplier", "s_suppkey", "s_nationkey"),
              F.col("l_suppkey") == F.col("s_suppkey"))
        .join(F.broadcast(read("nation", "n_nationkey", "n_name", "n_regionkey")),
              F.col("s_nationkey") == F.col("n_nationkey"))
        .drop("o_orderkey", "p_partkey", "s_suppkey", "n_nationkey")
    )


def landing_columns(df: DataFrame) -> DataFrame:
    """Add the 15 landing columns, computed from the joined sample columns."""
    part_key = F.col("l_partkey")
    ship = F.col("l_shipdate")
    online = F.col("l_linenumber") % 4 == 2

    clock = F.concat_ws(
        ":", (F.col("l_orderkey") % 24).cast("string"), (part_key % 60).cast("string")
    )
    refund = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7)
    price = F.when(refund, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    wording = (
        F.when(F.col("l_linenumber") % 4 == 0, "Swipe Transaction")
        .when(F.col("l_linenumber") % 4 == 1, " Chip Transaction")
        .when(online, "Online Transaction")
        .otherwise("Contactless")
    )
    error = (
        F.when(part_key % 7 == 0, "")
        .when(F.col("l_returnflag") == "A", " Bad PIN ")
        .when(F.col("l_returnflag") == "R", "Technical Glitch")
    )
    fraud = (
        F.when((F.col("l_linestatus") == "F") & (F.col("l_quantity") >= 49), "Yes")
        .when(part_key % 107 == 0, "Maybe")
        .otherwise("No")
    )
    landed = {
        "User": F.when(part_key % 97 != 0, F.col("o_custkey")),
        "Card": F.col("l_linenumber"),
        "Year": F.year(ship),
        "Month": F.month(ship),
        "Day": F.dayofmonth(ship),
        "Time": F.when(part_key % 101 == 0, "99:99").otherwise(clock),
        "Amount": F.when(part_key % 103 == 0, "UNKNOWN").otherwise(
            F.concat(F.lit("$"), F.format_number(price, 2))
        ),
        "Use Chip": wording,
        "Merchant Name": F.lit(FIRST_MERCHANT_ID) + F.col("l_suppkey"),
        "Merchant City": F.concat(F.lit(" "), F.col("n_name"), F.lit("\t")),
        "Merchant State": F.when(
            ~online, F.concat(F.lit(" R"), F.col("n_regionkey").cast("string"), F.lit(" "))
        ),
        "Zip": F.when(~online, F.lit(FIRST_ZIP) + F.col("s_nationkey")),
        "MCC": F.lit(FIRST_MCC) + F.col("p_size"),
        "Errors?": error,
        "Is Fraud?": fraud,
    }
    return df.withColumns(
        {name: landed[name].cast(contracts.TRANSACTIONS[name].dataType) for name in landed}
    )


def bronze_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows in arrival order, with audit and lineage columns.

    Range partitioning plus a sort inside each partition is a distributed global
    sort; the row counter is then increasing and gap-free within each partition. The
    landing columns are made after the sort, so the shuffle carries the narrow inputs.
    """
    ordered = (
        payments(spark, sf_dir)
        .repartitionByRange(*ARRIVAL_ORDER)
        .sortWithinPartitions(*ARRIVAL_ORDER)
        .withColumn("_position", F.monotonically_increasing_id())
    )
    return landing_columns(ordered).select(
        *contracts.TRANSACTIONS.fieldNames(),
        F.lit("lineitem.parquet").alias("_source_file_name"),
        F.lit(None).cast("bigint").alias("_source_file_size_bytes"),
        F.lit(None).cast("string").alias("_source_file_sha256"),
        F.lit("2026-01-01 00:00:00+00:00").cast("timestamp").alias("_ingestion_timestamp_utc"),
        F.lit("sample").alias("_pipeline_run_id"),
        F.lit(0).cast("bigint").alias("_source_sequence"),
        F.shiftright("_position", 33).alias("_source_block_start"),
        F.col("_position").bitwiseAND(F.lit((1 << 33) - 1)).alias("_source_row"),
    )
