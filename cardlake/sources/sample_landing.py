"""Landing CSV files made by Spark from the sample tables, one set per source domain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardlake import contracts
from cardlake.sources import tables


# About 30 MB of transactions. More rows make more files, not larger ones, as with real deliveries.
RECORDS_PER_FILE = 250_000


def write(df: DataFrame, path: str) -> None:
    """CSV files with a header, keeping blanks at the ends of values.

    Spark's first task leaves a file even if it has no rows, as when it scans a piece of a
    file in which no row group begins. A header alone is a broken file, so it is dropped.
    """
    (
        df.write.option("header", True).option("escape", '"').option("maxRecordsPerFile", RECORDS_PER_FILE)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    tables.drop_files_up_to(df.sparkSession, path, "*.csv", len(",".join(df.columns).encode()) + 1)


def transactions(bronze: DataFrame) -> DataFrame:
    return bronze.select(*[f"`{name}`" for name in contracts.TRANSACTIONS.fieldNames()])


def _shape(df: DataFrame, values: dict, contract) -> DataFrame:
    return df.select(*[values[field.name].alias(field.name) for field in contract])


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One card per customer."""
    key = F.col("c_custkey")
    return _shape(spark.read.parquet(f"{sf_dir}/customer.parquet"), {
        "User": key,
        "CARD INDEX": key % 3,
        "Card Brand": F.col("c_mktsegment"),
        "Card Type": F.lit("Credit"),
        "Card Number": F.lit(4_000_000_000_000_000) + key,
        "Expires": F.lit("12/2028"),
        "CVV": key % 900 + 100,
        "Has Chip": F.lit("YES"),
        "Cards Issued": key % 4 + 1,
        "Credit Limit": F.concat(F.lit("$"), F.format_number("c_acctbal", 2)),
        "Acct Open Date": F.lit("01/2020"),
        "Year PIN last Changed": key % 10 + 2014,
        "Card on Dark Web": F.lit("No"),
    }, contracts.CARDS)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One user per customer."""
    key = F.col("c_custkey")
    nation = F.col("c_nationkey")
    return _shape(spark.read.parquet(f"{sf_dir}/customer.parquet"), {
        "Person": F.col("c_name"),
        "Current Age": key % 60 + 20,
        "Retirement Age": F.lit(65),
        "Birth Year": F.lit(2006) - key % 60,
        "Birth Month": key % 12 + 1,
        "Gender": F.when(key % 2 == 0, "Female").otherwise("Male"),
        "Address": F.concat(key.cast("string"), F.lit(" Main Street")),
        "Apartment": (key % 50).cast("double"),
        "City": F.concat(F.lit("City, "), nation.cast("string")),
        "State": F.lit("ON"),
        "Zipcode": nation + 10000,
        "Latitude": nation / 10 + 40.5,
        "Longitude": -nation / 10 - 70.5,
        "Per Capita Income - Zipcode": F.lit("$35,000"),
        "Yearly Income - Person": F.lit("$72,000"),
        "Total Debt": F.concat(F.lit("$"), F.format_number("c_acctbal", 2)),
        "FICO Score": key % 350 + 500,
        "Num Credit Cards": key % 4 + 1,
    }, contracts.USERS)
