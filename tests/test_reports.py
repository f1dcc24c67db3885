from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardlake.operators import gold, profiling, serving
from cardlake.plans import measures, reports
from conftest import rows


def calendar(spark, first, last):
    frame = spark.createDataFrame(
        [(datetime.combine(day, datetime.min.time()),) for day in (first, last)],
        "transaction_timestamp timestamp_ntz")
    return gold.create_date_dimension(frame)


F_SCHEMA = ("transaction_key bigint, date_key bigint, merchant_key bigint, card_id bigint, "
            "transaction_timestamp timestamp_ntz, transaction_amount decimal(18,4), "
            "transaction_method string, merchant_category_code bigint, "
            "transaction_error string, is_fraud boolean")


def fact(spark, data):
    """(day, merchant, amount, fraud, error) rows."""
    return spark.createDataFrame([
        (i, int(day.strftime("%Y%m%d")), merchant, 1, datetime.combine(day, datetime.min.time()),
         Decimal(amount), "CHIP", 5411, error, fraud)
        for i, (day, merchant, amount, fraud, error) in enumerate(data, 1)
    ], F_SCHEMA)


def published(spark, data, dates, merchants=None):
    merchants = merchants or [(1, 100, "Graz", "ST", "8010", 5977)]
    dim = spark.createDataFrame(
        merchants, "merchant_key bigint, merchant_id bigint, merchant_city string, "
        "merchant_state string, merchant_zip_code string, merchant_category_code bigint")
    return serving.serving_frames(dim, dates, fact(spark, data))


def test_leap_day_is_shifted_once(spark):
    """28 and 29 February 2020 both move to 28 February 2019, which counts once."""
    dates = calendar(spark, date(2019, 1, 1), date(2020, 12, 31))
    frames = published(spark, [
        (date(2019, 2, 28), 1, "10", False, None), (date(2020, 2, 28), 1, "20", False, None),
        (date(2020, 2, 29), 1, "5", False, None)], dates)
    selected = frames["date"].where("date_key IN (20200228, 20200229)")
    row = measures.kpi_controls(frames["transaction"], frames["date"], selected).first()
    assert (row["total_transaction_amount"], row["prior_year_transaction_amount"]) == (25.0, 10.0)
    assert row["amount_yoy_growth"] == pytest.approx(1.5)
    years = {r["calendar_year"]: r for r in measures.yoy_by_year(
        frames["transaction"], frames["date"]).collect()}
    assert years[2020]["prior_year_transaction_amount"] == 10.0
    assert years[2019]["prior_year_transaction_amount"] is None
    assert years[2019]["amount_yoy_growth"] is None


def test_rates_over_no_rows_are_null(spark):
    dates = calendar(spark, date(2020, 1, 1), date(2020, 1, 2))
    frames = published(spark, [(date(2020, 1, 1), 1, "1", False, None)], dates)
    row = measures.portfolio(frames["transaction"].where("false")).first()
    assert row["transaction_count"] == 0
    assert row["fraud_rate"] is None and row["error_free_rate"] is None
    assert measures.portfolio(frames["transaction"]).first()["average_fraud_transaction_amount"] \
        is None


def test_direction_and_basis_points(spark):
    dates = calendar(spark, date(2019, 1, 1), date(2021, 12, 31))
    data = (
        [(date(2019, 5, 1), 1, "1", i < 1, None) for i in range(10)]
        + [(date(2020, 5, 1), 1, "1", i < 2, None) for i in range(10)]
        + [(date(2021, 5, 1), 1, "1", i < 2, "x") for i in range(10)])
    frames = published(spark, data, dates)
    found = measures.rate_changes_by_year(frames["transaction"], frames["date"]).collect()
    assert [r["risk_direction"] for r in found] == [None, "Worsening", "Stable"]
    assert found[1]["fraud_rate_change_bps"] == pytest.approx(1000)
    assert found[2]["error_rate_change_bps"] == pytest.approx(10000)
    text = measures.executive_briefs(frames["transaction"], frames["date"]).collect()
    assert text[0]["executive_decision_summary"] == (
        "Risk No prior year | Amount growth n/a | Fraud rate n/a bps | Error rate n/a bps"
        " | Data through 2019-05-01")
    assert text[1]["executive_decision_summary"].startswith(
        "Risk Worsening | Amount growth 0.00% | Fraud rate 1000.00 bps")


def test_profile_text_and_prompt(spark):
    dates = calendar(spark, date(2020, 1, 1), date(2020, 1, 2))
    merchants = [(1, -6100200300400500607, "Graz", "ST", "8010", 5977),
                 (2, 200, None, None, None, 5812)]
    frames = published(spark, [(date(2020, 1, 1), 1, "1", True, None)], dates, merchants)
    texts = dict(rows(measures.merchant_profiles(frames["merchant"])))
    assert texts["MRC-000001"] == (
        "MRC-000001  |  Source ID -6100200300400500607  |  Graz, ST 8010  |  Category 5977")
    assert texts["MRC-000002"] == "MRC-000002  |  Source ID 200  |  ONLINE  |  Category 5812"
    one = frames["merchant"].where("merchant_key = 2")
    assert measures.selected_merchant_profile(one).first()[0] == texts["MRC-000002"]
    for many in (frames["merchant"], frames["merchant"].where("false")):
        assert measures.selected_merchant_profile(many).first()[0] == measures.PROFILE_PROMPT


def test_tiers_ranks_and_portfolio(spark):
    dates = calendar(spark, date(2020, 1, 1), date(2020, 1, 2))
    day = date(2020, 1, 1)
    merchants = [(k, k, "c", None, None, 1) for k in range(1, 6)]
    data = (
        [(day, 1, "50", True, None)]                                     # rate 1
        + [(day, 2, "950", i == 0, None) for i in range(100)]            # low rate, large share
        + [(day, 3, "1", i == 0, None) for i in range(5)]                # rate 0.2, tiny share
        + [(day, 4, "1", i == 0, None) for i in range(50)]               # rate 0.02
        + [(day, 5, "1", False, "x")])
    frames = published(spark, data, dates, merchants)
    found = {r["merchant_display_label"]: r for r in measures.merchant_risk(
        frames["transaction"], frames["merchant"]).collect()}
    tiers = [found[f"MRC-00000{k}"]["risk_tier"] for k in range(1, 6)]
    assert tiers == ["Critical", "High", "High", "Elevated", "Low"]
    ranks = [found[f"MRC-00000{k}"]["exposure_rank"] for k in range(1, 6)]
    assert ranks == [2, 1, 3, 3, None]
    assert found["MRC-000005"]["risk_insight"] == "No fraud recorded"
    one = measures.merchant_vs_portfolio(
        frames["transaction"], frames["merchant"], "MRC-000003").collect()
    assert len(one) == 1 and one[0]["selected_merchant_fraud_rate"] == pytest.approx(0.2)
    assert one[0]["portfolio_fraud_rate"] == pytest.approx(4 / 157)
    top = measures.exposure_concentration(frames["transaction"]).first()
    assert top["fraudulent_merchant_count"] == 4 and top["top_10_fraud_exposure_share"] == 1.0
    assert measures.top_merchant_label(frames["transaction"]) == "MRC-000002"
    ledger = measures.evidence_ledger(
        frames["transaction"], frames["date"], frames["merchant"], "MRC-000005").first()
    assert (ledger["fraud_cell_color"], ledger["error_cell_color"]) == ("#FFFFFF", "#FFF4E5")
    assert measures.evidence_ledger(
        frames["transaction"], frames["date"], frames["merchant"], None).count() == 0


def test_blank_and_missing_states_share_a_label(spark):
    dates = calendar(spark, date(2020, 1, 1), date(2020, 1, 2))
    day = date(2020, 1, 1)
    dim = spark.createDataFrame(
        [(1, ""), (2, " ON"), (3, "ON"), (4, None)], "merchant_key bigint, merchant_state string")
    data = fact(spark, [(day, k, "1", False, None) for k in (1, 2, 3, 4)])
    assert sorted(rows(reports.top_states(data, dates, dim),
                       "merchant_state", "transaction_count")) == [("ON", 2), ("UNKNOWN", 2)]


def test_selection_and_empty_selection(spark):
    dates = calendar(spark, date(2019, 12, 31), date(2020, 1, 2))
    data = fact(spark, [(date(2019, 12, 31), 1, "1", False, None),
                        (date(2020, 1, 1), 1, "2.005", True, None)])
    row = reports.kpis(data, dates, years=[2020]).first()
    assert (row["total_transactions"], row["total_transaction_amount"]) == (1, 2.01)
    assert set(reports.kpis(data, dates, years=[1990]).first()) == {0}
    assert reports.kpis(data, dates).first()["total_transactions"] == 2
    assert rows(reports.years(dates)) == [(2019,), (2020,)]


def test_sample_export(spark, tmp_path):
    frame = spark.range(1000).select("id", F.lit('a "b", c').alias("text"))
    reports.write_sample_csv(frame, str(tmp_path / "out"))
    parts = list((tmp_path / "out").glob("*.csv"))
    assert len(parts) == 1
    import pandas as pd

    back = pd.read_csv(parts[0])
    assert len(back) == 500 and set(back["text"]) == {'a "b", c'}


# ----------------------------------------------------------------------- profiles


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [(1, "a", 1.5), (1, "a", 1.5), (2, None, None), (3, "b", 4.0), (None, "a", 2.0)],
        "k bigint, `t x?` string, v double")


def test_missing_distinct_and_shape(table):
    assert rows(profiling.missing_values(table)) == [
        ("k", 1, 20.0), ("t x?", 1, 20.0), ("v", 1, 20.0)]
    assert rows(profiling.distinct_values(table)) == [("k", 3), ("t x?", 2), ("v", 3)]
    assert dict(rows(profiling.distinct_values(table, approximate=True))) == {
        "k": 3, "t x?": 2, "v": 3}
    assert rows(profiling.shape(table), "rows", "column_name", "data_type") == [
        (5, "k", "bigint"), (5, "t x?", "string"), (5, "v", "double")]


def test_value_counts_with_nulls(table):
    assert rows(profiling.value_counts(table, ["t x?"], top=2), "value", "value_count") == [
        ("a", 3), ("b", 1)]
    assert (None, 1) in rows(profiling.value_counts(table, ["t x?"]), "value", "value_count")


def test_duplicates(table):
    assert profiling.duplicate_rows(table).first()[0] == 1


def test_summary_equals_pandas(table):
    wanted = table.toPandas()["v"].describe()
    row = profiling.numeric_summary(table, ["v"]).first()
    assert [row[name] for name in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")] \
        == pytest.approx(list(wanted))
    whole = {r["column_name"]: r for r in profiling.summary(table).collect()}
    assert (whole["t x?"]["top"], whole["t x?"]["freq"], whole["t x?"]["unique"]) == ("a", 3, 2)
    assert whole["v"]["p50"] == pytest.approx(wanted["50%"])


def test_contract_report():
    report = profiling.contract_report(["User"], {"User": "str"}, "cards")
    assert not report["columns"]["is_valid"]
    assert report["types"]["mismatched_columns"]["User"] == {"expected": "int64", "actual": "str"}
