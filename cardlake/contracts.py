"""Source contracts: columns, types and sensitive fields of every landing domain."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, types as T

# Column names and types of the three source systems.
TRANSACTIONS = T.StructType([
    T.StructField("User", T.LongType()),
    T.StructField("Card", T.LongType()),
    T.StructField("Year", T.LongType()),
    T.StructField("Month", T.LongType()),
    T.StructField("Day", T.LongType()),
    T.StructField("Time", T.StringType()),
    T.StructField("Amount", T.StringType()),
    T.StructField("Use Chip", T.StringType()),
    T.StructField("Merchant Name", T.LongType()),
    T.StructField("Merchant City", T.StringType()),
    T.StructField("Merchant State", T.StringType()),
    T.StructField("Zip", T.DoubleType()),
    T.StructField("MCC", T.LongType()),
    T.StructField("Errors?", T.StringType()),
    T.StructField("Is Fraud?", T.StringType()),
])

_SENSITIVE = {"sensitive": True}

CARDS = T.StructType([
    T.StructField("User", T.LongType()),
    T.StructField("CARD INDEX", T.LongType()),
    T.StructField("Card Brand", T.StringType()),
    T.StructField("Card Type", T.StringType()),
    T.StructField("Card Number", T.LongType(), metadata=_SENSITIVE),
    T.StructField("Expires", T.StringType()),
    T.StructField("CVV", T.LongType(), metadata=_SENSITIVE),
    T.StructField("Has Chip", T.StringType()),
    T.StructField("Cards Issued", T.LongType()),
    T.StructField("Credit Limit", T.StringType()),
    T.StructField("Acct Open Date", T.StringType()),
    T.StructField("Year PIN last Changed", T.LongType()),
    T.StructField("Card on Dark Web", T.StringType()),
])

USERS = T.StructType([
    T.StructField("Person", T.StringType(), metadata=_SENSITIVE),
    T.StructField("Current Age", T.LongType()),
    T.StructField("Retirement Age", T.LongType()),
    T.StructField("Birth Year", T.LongType()),
    T.StructField("Birth Month", T.LongType()),
    T.StructField("Gender", T.StringType()),
    T.StructField("Address", T.StringType(), metadata=_SENSITIVE),
    T.StructField("Apartment", T.DoubleType(), metadata=_SENSITIVE),
    T.StructField("City", T.StringType()),
    T.StructField("State", T.StringType()),
    T.StructField("Zipcode", T.LongType()),
    T.StructField("Latitude", T.DoubleType(), metadata=_SENSITIVE),
    T.StructField("Longitude", T.DoubleType(), metadata=_SENSITIVE),
    T.StructField("Per Capita Income - Zipcode", T.StringType()),
    T.StructField("Yearly Income - Person", T.StringType()),
    T.StructField("Total Debt", T.StringType()),
    T.StructField("FICO Score", T.LongType()),
    T.StructField("Num Credit Cards", T.LongType()),
])

REGISTRY: dict[str, T.StructType] = {
    "transactions": TRANSACTIONS,
    "cards": CARDS,
    "users": USERS,
}

# Audit columns every bronze table carries, in order.
AUDIT = T.StructType([
    T.StructField("_source_file_name", T.StringType()),
    T.StructField("_source_file_size_bytes", T.LongType()),
    T.StructField("_source_file_sha256", T.StringType()),
    T.StructField("_ingestion_timestamp_utc", T.TimestampType()),
    T.StructField("_pipeline_run_id", T.StringType()),
])

# Position of a row in the landing area: which file, which block of it, which row.
# Sorting by all three gives the order in which the rows arrived.
LINEAGE = T.StructType([
    T.StructField("_source_sequence", T.LongType()),
    T.StructField("_source_block_start", T.LongType()),
    T.StructField("_source_row", T.LongType()),
])

# Type names used in contract reports.
TYPE_NAMES = {T.LongType(): "int64", T.DoubleType(): "float64", T.StringType(): "str"}


def contract_for(domain: str) -> tuple[str, T.StructType]:
    """Normalised domain name and its contract; unknown domains are rejected."""
    name = domain.strip().lower()
    if name not in REGISTRY:
        raise ValueError(
            f"Unknown source domain: {domain}. Available domains: {sorted(REGISTRY)}"
        )
    return name, REGISTRY[name]


def expected_types(contract: T.StructType) -> dict[str, str]:
    return {field.name: TYPE_NAMES[field.dataType] for field in contract}


def sensitive_columns(contract: T.StructType) -> list[str]:
    return [field.name for field in contract if field.metadata.get("sensitive")]


def check_columns(actual: Iterable[str], expected: Iterable[str]) -> dict:
    """Compare two column sets; order does not matter."""
    actual, expected = list(actual), list(expected)
    missing = sorted(set(expected) - set(actual))
    unexpected = sorted(set(actual) - set(expected))
    return {
        "is_valid": not missing and not unexpected and len(actual) == len(set(actual)),
        "expected_count": len(expected),
        "actual_count": len(actual),
        "missing_columns": missing,
        "unexpected_columns": unexpected,
    }


def check_types(actual: dict[str, str], expected: dict[str, str]) -> dict:
    """Per-column type differences between an observed and an expected layout."""
    mismatched = {
        name: {"expected": wanted, "actual": actual.get(name)}
        for name, wanted in expected.items()
        if actual.get(name) != wanted
    }
    return {"is_valid": not mismatched, "mismatched_columns": mismatched}


def require_columns(df: DataFrame, required: Iterable[str], table: str) -> None:
    """Reject a table that lacks columns, naming all of them at once."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{table} is missing required columns: {missing}")


def without_sensitive(df: DataFrame, contract: T.StructType) -> DataFrame:
    return df.drop(*sensitive_columns(contract))


def assert_not_exposed(df: DataFrame, table: str) -> None:
    """Fail when a published table holds a sensitive source column of any domain."""
    secret = {name for contract in REGISTRY.values() for name in sensitive_columns(contract)}
    leaked = sorted(secret & set(df.columns))
    if leaked:
        raise ValueError(f"{table} exposes sensitive columns: {leaked}")
