"""Dashboard reports over the gold tables.

Every report takes the tables and an optional year and method selection and returns a
lazy DataFrame. An empty selection means no restriction.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from cardlake.functions import columns as C
from cardlake.operators.gold import FACT_YEAR

SAMPLE_ROWS = 500
TOP_ROWS = 15


def select_facts(
    fact: DataFrame,
    dates: DataFrame,
    years: Iterable[int] = (),
    methods: Iterable[str] = (),
) -> DataFrame:
    """Fact rows in the selection, with their calendar year.

    Whether the calendar is broadcast is left to its size: one wrong year among the
    timestamps can make it millions of days long. A year also fixes the directory of a
    fact row; adding that condition lets the scan skip the other directories, which the
    calendar filter alone could not.
    """
    years, methods = list(years), list(methods)
    calendar = dates.select("date_key", "calendar_year")
    if years:
        calendar = calendar.where(F.col("calendar_year").isin(years))
        if FACT_YEAR in fact.columns:
            fact = fact.where(F.col(FACT_YEAR).isin(years))
    if methods:
        fact = fact.where(F.col("transaction_method").isin(methods))
    return fact.join(calendar, "date_key")


def amount() -> Column:
    return C.money(F.col("transaction_amount"))


def total_amount() -> Column:
    return C.round2(F.sum(amount())).alias("total_transaction_amount")


def average_amount() -> Column:
    units = C.whole(F.sum(amount()))
    average = C.quotient2(units, F.count(amount()).cast("decimal(20,0)") * 10000)
    return average.cast("double").alias("average_transaction_amount")


def transactions(name: str = "transaction_count") -> Column:
    return F.count(F.lit(1)).alias(name)


def frauds() -> Column:
    return C.count_where(F.col("is_fraud")).alias("fraudulent_transactions")


def fraud_percent(name: str = "fraud_rate_percent") -> Column:
    share = C.quotient2(100 * C.count_where(F.col("is_fraud")), F.count(F.lit(1)))
    return share.cast("double").alias(name)


def years(dates: DataFrame) -> DataFrame:
    return dates.select("calendar_year").distinct().orderBy("calendar_year")


def methods(fact: DataFrame) -> DataFrame:
    known = fact.where(F.col("transaction_method").isNotNull())
    return known.select("transaction_method").distinct().orderBy("transaction_method")


def kpis(fact: DataFrame, dates: DataFrame, years=(), methods=()) -> DataFrame:
    """One row; an empty selection of rows shows zeros."""
    row = select_facts(fact, dates, years, methods).agg(
        transactions("total_transactions"), total_amount(), average_amount(), frauds(),
        fraud_percent("fraud_transaction_rate_percent"),
    )
    return row.na.fill(0)


def annual_summary(fact: DataFrame, dates: DataFrame, years=(), methods=()) -> DataFrame:
    return (
        select_facts(fact, dates, years, methods)
        .groupBy("calendar_year")
        .agg(transactions(), total_amount(), frauds())
        .orderBy("calendar_year")
    )


def method_summary(fact: DataFrame, dates: DataFrame, years=(), methods=()) -> DataFrame:
    return (
        select_facts(fact, dates, years, methods)
        .groupBy("transaction_method")
        .agg(transactions(), total_amount(), average_amount())
        .orderBy(F.desc("transaction_count"), "transaction_method")
    )


def fraud_by_method(fact: DataFrame, dates: DataFrame, years=(), methods=()) -> DataFrame:
    return (
        select_facts(fact, dates, years, methods)
        .groupBy("transaction_method")
        .agg(transactions(), frauds(), fraud_percent())
        .orderBy(F.desc("fraud_rate_percent"), "transaction_method")
    )


def fraud_by_year(fact: DataFrame, dates: DataFrame, years=(), methods=()) -> DataFrame:
    return (
        select_facts(fact, dates, years, methods)
        .groupBy("calendar_year")
        .agg(frauds(), fraud_percent())
        .orderBy("calendar_year")
    )


def top_states(
    fact: DataFrame, dates: DataFrame, merchants: DataFrame, years=(), methods=()
) -> DataFrame:
    """States with the largest amounts; blank and missing states share one label.

    Facts are reduced to one row per merchant before they meet the merchant table, so
    only totals are shuffled and a hot merchant does not skew the join.
    """
    per_merchant = (
        select_facts(fact, dates, years, methods)
        .groupBy("merchant_key")
        .agg(
            transactions("n"), F.sum(amount()).alias("amount"), frauds(),
        )
    )
    state = F.coalesce(
        F.nullif(C.strip_text(F.col("merchant_state")), F.lit("")), F.lit("UNKNOWN")
    )
    return (
        per_merchant.join(merchants.select("merchant_key", "merchant_state").hint("merge"), "merchant_key")
        .groupBy(state.alias("merchant_state"))
        .agg(
            F.sum("n").alias("transaction_count"),
            C.round2(F.sum("amount")).alias("total_transaction_amount"),
            F.sum("fraudulent_transactions").alias("fraudulent_transactions"),
        )
        .orderBy(F.desc("total_transaction_amount"), "merchant_state")
        .limit(TOP_ROWS)
    )


def top_categories(fact: DataFrame, dates: DataFrame, years=(), methods=()) -> DataFrame:
    return (
        select_facts(fact, dates, years, methods)
        .groupBy("merchant_category_code")
        .agg(transactions(), total_amount(), frauds(), fraud_percent())
        .orderBy(
            F.desc("transaction_count"), F.col("merchant_category_code").asc_nulls_last()
        )
        .limit(TOP_ROWS)
    )


def latest_transactions(
    fact: DataFrame, dates: DataFrame, merchants: DataFrame, years=(), methods=(),
    rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The newest transactions with merchant and year.

    The newest rows are picked before the merchant join, each task keeping only its
    own candidates; the join then touches ``rows`` rows. Validated gold has a merchant
    for each fact row, so the join removes none of them.
    """
    newest = (
        select_facts(fact, dates, years, methods)
        .orderBy(F.desc("transaction_timestamp"), F.desc("transaction_key"))
        .limit(rows)
    )
    places = merchants.select("merchant_key", "merchant_city", "merchant_state")
    return (
        places.join(F.broadcast(newest), "merchant_key")
        .select(
            "transaction_key", "transaction_timestamp", "transaction_amount",
            "transaction_method", "is_fraud", "transaction_error",
            "merchant_category_code", "merchant_city", "merchant_state", "calendar_year",
        )
        .orderBy(F.desc("transaction_timestamp"), F.desc("transaction_key"))
    )


def write_sample_csv(report: DataFrame, path: str, rows: int = SAMPLE_ROWS) -> None:
    """Export a bounded sample as one CSV file with a header."""
    (
        report.limit(rows).coalesce(1)
        .write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    )
