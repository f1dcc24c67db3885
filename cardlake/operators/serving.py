"""Reporting tables: a fixed contract over gold, checked before and after writing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardlake import contracts
from cardlake.functions import columns as C
from cardlake.operators import gold, quality
from cardlake.operators.rows import one_row
from cardlake.sources import tables

# Published columns of the three reporting tables.
FACT_SOURCE = (
    "transaction_key", "date_key", "merchant_key", "card_id", "transaction_timestamp",
    "transaction_amount", "transaction_method", "transaction_error", "is_fraud",
)
DATE_SOURCE = (
    "date_key", "full_date", "calendar_year", "calendar_quarter",
    "calendar_month_number", "calendar_month_name", "calendar_day_of_month",
    "calendar_day_of_week_number", "calendar_day_name", "is_weekend",
)
MERCHANT_SOURCE = ("merchant_key", *gold.MERCHANT_COLUMNS)
TABLE_NAMES = {
    "date": "dim_date_analytics",
    "merchant": "dim_merchant_analytics",
    "transaction": "fact_transaction_analytics",
}


def merchant_label(key: Column) -> Column:
    """``MRC-`` and at least six digits; longer keys are never cut."""
    return F.format_string("MRC-%06d", key)


def merchant_key_of(label: str) -> int:
    """The key inside a label, so that a label filter can be pushed down to the scan."""
    return int(label.removeprefix("MRC-"))


def serving_frames(
    merchants: DataFrame, dates: DataFrame, fact: DataFrame
) -> dict[str, DataFrame]:
    """The three reporting tables; everything outside the contract is left out."""
    contracts.require_columns(merchants, MERCHANT_SOURCE, "dim_merchant")
    contracts.require_columns(dates, DATE_SOURCE, "dim_date")
    contracts.require_columns(fact, FACT_SOURCE, "fact_transaction")
    directory = [name for name in (gold.FACT_YEAR,) if name in fact.columns]
    return {
        "date": dates.select(
            *DATE_SOURCE,
            F.date_format("full_date", "yyyy-MM").alias("calendar_year_month"),
            (F.col("calendar_year") * 100 + F.col("calendar_month_number"))
            .alias("calendar_year_month_sort"),
        ),
        "merchant": merchants.select(
            *MERCHANT_SOURCE,
            F.col("merchant_id").cast("string").alias("merchant_id_text"),
            merchant_label(F.col("merchant_key")).alias("merchant_display_label"),
        ),
        "transaction": fact.select(
            *FACT_SOURCE,
            C.has_error(F.col("transaction_error")).alias("has_error"),
            *directory,
        ),
    }


def serving_controls(
    source: Mapping[str, DataFrame], published: Mapping[str, DataFrame],
    source_controls: DataFrame | None = None,
) -> DataFrame:
    """One row comparing the reporting tables with the gold tables behind them.

    ``source_controls`` are the controls that gold keeps with its fact; without them the gold
    tables are scanned for the same numbers. The published fact is scanned once.
    """
    dates, merchants, fact = (published[name] for name in ("date", "merchant", "transaction"))
    if source_controls is None:
        source_controls = quality.star_controls(
            source["merchant"], source["date"], source["transaction"], gold.fact_totals())
    totals = {**gold.fact_totals(), "error_transaction_count": F.col("has_error").cast("bigint")}
    names = {"actual_fact_rows": "transaction_rows"}
    compared = ("date_rows", "merchant_rows", "transaction_rows", *gold.FACT_TOTALS)
    # Text identifiers are compared per merchant key, both sides being one row per key.
    texts = merchants.select("merchant_key", "merchant_id_text").join(
        source["merchant"].select("merchant_key", "merchant_id").hint("merge"), "merchant_key", "left"
    )
    labels = merchants.groupBy("merchant_display_label").agg(F.count(F.lit(1)).alias("n"))
    row = one_row(
        quality.star_controls(merchants, dates, fact, totals).withColumnsRenamed(names),
        source_controls.withColumnsRenamed(names).select(
            *[F.col(name).alias(f"source_{name}") for name in compared]),
        texts.agg(
            C.count_where(F.col("merchant_id_text").isNull()).alias("missing_merchant_id_text"),
            C.count_where(
                ~F.col("merchant_id_text").eqNullSafe(F.col("merchant_id").cast("string"))
            ).alias("merchant_id_text_mismatches"),
        ),
        labels.agg(
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint")
            .alias("duplicate_merchant_display_labels")
        ),
        dates.agg(
            C.count_where(
                F.col("calendar_year_month").isNull()
                | F.col("calendar_year_month_sort").isNull()
            ).alias("missing_month_labels")
        ),
    )
    faults = [
        name for name in row.columns
        if name.startswith(("missing", "duplicate", "invalid")) or name.endswith("mismatches")
    ]
    valid = sum((F.col(name) for name in faults), F.lit(0)) == 0
    amount = "transaction_amount_total"
    for name in compared:
        difference = F.col(name) - F.col(f"source_{name}")
        valid = valid & (F.abs(difference) < 0.005 if name == amount else difference == 0)
    return row.withColumn("is_valid", valid).withColumns({
        name: F.col(name).cast("double") for name in (amount, f"source_{amount}")
    })


def write_serving(frames: Mapping[str, DataFrame], directory: str) -> dict[str, str]:
    """Write each table under its fixed name; the fact keeps its year directories and order.

    Tasks read few merchants each, as gold is clustered, so a sort inside each task keeps
    the merchants together without a shuffle.
    """
    paths = {name: f"{directory}/{TABLE_NAMES[name]}.parquet" for name in frames}
    for name, df in frames.items():
        contracts.assert_not_exposed(df, TABLE_NAMES[name])
        partition = tuple(column for column in (gold.FACT_YEAR,) if column in df.columns)
        if partition:
            df = df.sortWithinPartitions(*gold.CLUSTERING)
        tables.overwrite(df, paths[name], partition, gold.ROW_GROUP_BYTES if partition else None)
    return paths


def _row_digest(columns: list[str]) -> Column:
    return F.xxhash64(*columns).cast("decimal(38,0)")


def content_digest(df: DataFrame) -> DataFrame:
    """One row: number of rows and the sum of their 64-bit hashes.

    Equal tables give equal digests in any row order, at the cost of one scan and no
    shuffle.
    """
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(_row_digest(df.columns)), F.lit(0)).alias("digest"),
    )


def _same_layout(left: DataFrame, right: DataFrame) -> bool:
    def layout(df: DataFrame) -> list[tuple[str, str]]:
        return [(field.name, field.dataType.simpleString()) for field in df.schema]

    return layout(left) == layout(right)


def same_content(left: DataFrame, right: DataFrame) -> bool:
    """Same column names, types and order, and the same rows."""
    return _same_layout(left, right) and content_digest(left).first() == content_digest(right).first()


def validate_stored(
    spark: SparkSession, frames: Mapping[str, DataFrame], paths: Mapping[str, str]
) -> dict:
    """Reload what was written and prove that writing preserved it.

    The stored fact is scanned once, for its content and its relationships together.
    """
    stored = {name: spark.read.parquet(path) for name, path in paths.items()}
    same = {name: stored[name].select(df.columns) for name, df in frames.items()}
    controls = quality.star_controls(
        stored["merchant"], stored["date"], same["transaction"],
        {"digest": _row_digest(frames["transaction"].columns)},
    ).first()
    for name, df in frames.items():
        if name == "transaction":
            written = content_digest(df).first()
            kept = _same_layout(df, same[name]) and tuple(written) == (
                controls["actual_fact_rows"], controls["digest"])
        else:
            kept = same_content(df, same[name])
        if not kept:
            raise ValueError(f"{TABLE_NAMES[name]} was not stored as computed")
    result = {
        "date_rows": controls["date_rows"], "merchant_rows": controls["merchant_rows"],
        "transaction_rows": controls["actual_fact_rows"],
        "invalid_date_foreign_keys": controls["invalid_date_foreign_keys"],
        "invalid_merchant_foreign_keys": controls["invalid_merchant_foreign_keys"],
    }
    result["is_valid"] = not (
        result["invalid_date_foreign_keys"] or result["invalid_merchant_foreign_keys"]
    )
    return quality.require_valid(result, "Stored reporting model")


def build_serving(
    spark: SparkSession, merchant_path: str, date_path: str, fact_path: str, directory: str
) -> dict:
    """Gold tables -> validated, written and re-validated reporting tables."""
    tables.require_paths(
        spark,
        {"dim_merchant": merchant_path, "dim_date": date_path, "fact_transaction": fact_path},
        "The reporting layer",
    )
    source = {
        "merchant": spark.read.parquet(merchant_path),
        "date": spark.read.parquet(date_path),
        "transaction": gold.read_fact(spark, fact_path),
    }
    frames = serving_frames(source["merchant"], source["date"], source["transaction"])
    validation = quality.require_valid(
        serving_controls(
            source, frames, gold.stored_controls(spark, merchant_path, date_path, fact_path)
        ).first().asDict(), "Reporting model"
    )
    paths = write_serving(frames, directory)
    return {
        "status": "SUCCESS",
        "output_directory": directory,
        "output_paths": paths,
        "validation": validation,
        "persisted_validation": validate_stored(spark, frames, paths),
    }
