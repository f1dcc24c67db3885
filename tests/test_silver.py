from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardlake.functions import columns as C
from cardlake.operators import ingest, silver
from cardlake import contracts
from conftest import NOW, rows

SCHEMA = (
    "User bigint, Card bigint, Year bigint, Month bigint, Day bigint, Time string, "
    "Amount string, `Use Chip` string, `Merchant Name` bigint, `Merchant City` string, "
    "`Merchant State` string, Zip double, MCC bigint, `Errors?` string, `Is Fraud?` string, "
    "_source_file_name string, _ingestion_timestamp_utc timestamp, _pipeline_run_id string"
)
AUDIT = ("sample.csv", NOW, "run-1")
GOOD = [
    (0, 0, 2026, 8, 1, "10:00", "$31.90", "Chip Transaction", 1, " Brno ", "JM", 60200.0,
     5411, None, "No", *AUDIT),
    (7, 2, 2026, 8, 3, "6:45", "$2,048.16", "Online Transaction", 44, "Gent", "VOV", None,
     5977, "Bad CVV", "Yes", *AUDIT),
]
BAD = (None, 0, 2026, 8, 1, "99:99", "UNKNOWN", "Chip Transaction", 1, "Brno", "JM", 60200.0,
       5411, None, "Maybe", *AUDIT)


def clean(spark, data, schema=SCHEMA):
    return silver.clean_transactions(spark.createDataFrame(data, schema), NOW)


def test_clean_rows(spark):
    out = silver.silver_rows(clean(spark, GOOD)).orderBy("user_id")
    assert out.columns == list(silver.SILVER_COLUMNS)
    first, second = out.collect()
    assert first["transaction_amount"] == Decimal("31.90")
    assert first["transaction_timestamp"] == datetime(2026, 8, 1, 10)
    assert (first["transaction_method"], second["transaction_method"]) == ("CHIP", "ONLINE")
    assert (first["is_fraud"], second["is_fraud"]) == (False, True)
    assert (first["merchant_zip_code"], second["merchant_zip_code"]) == ("60200", None)
    assert (first["transaction_error"], second["transaction_error"]) == (
        "NO_ERROR", "Bad CVV")
    assert first["merchant_city"] == "Brno"


def test_all_reasons_in_rule_order(spark):
    out = silver.quarantine_rows(clean(spark, [*GOOD, BAD]))
    assert out.columns == list(silver.QUARANTINE_COLUMNS)
    row = out.first()
    assert row["quarantine_reason"] == (
        "MISSING_USER_ID;INVALID_AMOUNT;INVALID_TRANSACTION_TIMESTAMP;INVALID_FRAUD_FLAG")
    assert (row["transaction_amount_raw"], row["transaction_amount"]) == ("UNKNOWN", None)
    no_card = (0, None, *BAD[2:])
    assert "MISSING_CARD_ID" in clean(spark, [no_card]).first()["quarantine_reason"]


def test_missing_merchant_and_category_are_no_reason(spark):
    row = (*GOOD[0][:8], None, *GOOD[0][9:12], None, *GOOD[0][13:])
    assert silver.silver_rows(clean(spark, [row])).count() == 1


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match=r"\['Amount', 'Zip'\]"):
        silver.clean_transactions(
            spark.createDataFrame(GOOD, SCHEMA).drop("Amount", "Zip"), NOW)


def test_build_reconciles_and_keeps_raw_values(spark, tmp_path):
    bronze, out = str(tmp_path / "bronze"), str(tmp_path / "silver")
    spark.createDataFrame([*GOOD, BAD], SCHEMA).write.parquet(bronze)
    result = silver.build_silver(spark, bronze, out, NOW)
    assert (result["bronze_rows_read"], result["silver_rows_written"],
            result["quarantine_rows_written"]) == (3, 2, 1)
    assert result["reconciliation_passed"] and result["status"] == "SUCCESS"
    assert silver.read_quarantine(spark, out).first()["transaction_time"] == "99:99"
    assert silver.read_silver(spark, out).count() == 2


@pytest.mark.parametrize("data, counts", [([], (0, 0, 0)), ([BAD], (1, 0, 1)), (GOOD, (2, 2, 0))])
def test_build_with_an_empty_side(spark, tmp_path, data, counts):
    bronze = str(tmp_path / "bronze")
    spark.createDataFrame(data, SCHEMA).write.parquet(bronze)
    result = silver.build_silver(spark, bronze, str(tmp_path / "silver"), NOW)
    assert (result["bronze_rows_read"], result["silver_rows_written"],
            result["quarantine_rows_written"]) == counts


def test_missing_input(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="Bronze"):
        silver.build_silver(spark, str(tmp_path / "x"), str(tmp_path / "y"), NOW)


def test_build_reads_what_ingest_wrote(spark, landing):
    area = ingest.DomainPaths(
        str(landing / "landing/transactions"), str(landing / "b"), str(landing / "l"))
    ingest.ingest_domain(spark, "transactions", area, now=NOW)
    result = silver.build_silver(spark, area.bronze, str(landing / "s"), NOW)
    assert result["silver_rows_written"] == 5
    assert set(contracts.LINEAGE.fieldNames()) <= set(
        silver.read_silver(spark, str(landing / "s")).columns)


# ------------------------------------------------------------------ scalar rules


def values(spark, expression, data, schema="v string"):
    frame = spark.createDataFrame([(item,) for item in data], schema)
    return [row[0] for row in frame.select(expression(F.col("v"))).collect()]


def test_money(spark):
    data = ["$25.50", "$-5.00", "$1,234.50", " 25 ", "1e3", "5.", "\t$7 ", "$1.239",
            "12d", "nan", "1_000", "", "UNKNOWN", None]
    assert values(spark, C.parse_money, data) == [
        Decimal("25.50"), Decimal("-5"), Decimal("1234.50"), Decimal(25), Decimal(1000),
        Decimal(5), Decimal(7), Decimal("1.239"), None, None, None, None, None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamp_parts(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        data = [
            (2024, 2, 29, "9:05"), (2024, 1, 3, "10:5"), (2024, 3, 10, " 02:30\t"),
            (2024, 2, 30, "10:00"), (2024, 1, 1, "24:00"), (2024, 1, 1, "10:00:00"),
            (2024, 13, 1, "10:00"), (None, 1, 1, "10:00"), (2024, 1, 1, None),
        ]
        frame = spark.createDataFrame(data, "y bigint, m bigint, d bigint, t string")
        found = [row[0] for row in frame.select(
            C.assemble_timestamp(F.col("y"), F.col("m"), F.col("d"), F.col("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == [
        datetime(2024, 2, 29, 9, 5), datetime(2024, 1, 3, 10, 5), datetime(2024, 3, 10, 2, 30),
        None, None, None, None, None, None]


def test_numbers_from_text(spark):
    data = ["7", "7.0", "7.5", " 8 ", "x", "9223372036854775807", "9223372036854775808", None]
    expression = lambda column: C.parse_int64(column, spark.range(0).selectExpr(
        "'' AS v").schema["v"].dataType)
    assert values(spark, expression, data) == [
        7, 7, None, 8, None, 9223372036854775807, None, None]


def test_zip_codes(spark):
    from pyspark.sql import types as T

    numbers = values(spark, lambda c: C.zip_text(c, T.DoubleType()),
                     [10001.0, 123456789.0, 1.5, float("nan"), None], "v double")
    assert numbers == ["10001", "123456789", "1.5", None, None]
    text = values(spark, lambda c: C.zip_text(c, T.StringType()), [" K1P ", "10001.0", None])
    assert text == ["K1P", "10001", None]


def test_method_error_and_fraud_words(spark):
    assert values(spark, C.method_code, [
        " Swipe Transaction\n", "chip transaction", "Chip Transaction", "", None]) == [
        "SWIPE", "UNKNOWN", "CHIP", "UNKNOWN", "UNKNOWN"]
    assert values(spark, C.error_text, ["\tBad PIN ", "  ", "", None]) == [
        "Bad PIN", "NO_ERROR", "NO_ERROR", "NO_ERROR"]
    assert values(spark, C.fraud_flag, [" Yes", "No ", "yes", None]) == [True, False, None, None]
    assert rows(spark.createDataFrame([(None,), ("NO_ERROR",), ("x",)], "v string").select(
        C.has_error(F.col("v")))) == [(False,), (False,), (True,)]


def test_rounding_is_half_up_on_the_decimal_value(spark):
    assert values(spark, C.round2, [1.005, 2.675, -1.005], "v double") == [1.01, 2.68, -1.01]
