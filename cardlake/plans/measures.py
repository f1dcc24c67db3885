"""Business measures over the reporting tables.

A filter context is a filtered fact. Time measures work on a daily rollup and merchant
measures on a merchant rollup: the fact is scanned once and combined before the
shuffle, and everything after that is as small as the calendar or the merchant list.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardlake.functions import columns as C
from cardlake.operators import keys, serving
from cardlake.operators.rows import one_row
from cardlake.session import stage

TOP_MERCHANTS = 10

# Cell colours of the evidence ledger.
FRAUD_COLOR, ERROR_COLOR, PLAIN_COLOR = "#FDECEC", "#FFF4E5", "#FFFFFF"
PROFILE_PROMPT = "Drill through from Merchant Risk to select one merchant"

# Risk tiers by merchant fraud rate, lowest first; a merchant with at least this share
# of all fraud exposure moves up one tier.
TIERS = ("Low", "Elevated", "High", "Critical")
HIGH_RATE, CRITICAL_RATE, LARGE_SHARE = 0.10, 0.50, 0.10


def _basics() -> list[Column]:
    amount = C.money(F.col("transaction_amount"))
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(amount).alias("amount"),
        C.count_where(F.col("is_fraud")).alias("frauds"),
        C.count_where(F.col("has_error")).alias("errors"),
        F.sum(F.when(F.col("is_fraud"), amount)).alias("exposure"),
    ]


def _sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in ("n", "amount", "frauds", "errors", "exposure")]


def rollup(fact: DataFrame, key: str) -> DataFrame:
    """Counts and exact sums per key; hot keys are combined before the shuffle."""
    return fact.groupBy(key).agg(*_basics())


def _by_key(merchants: DataFrame, column: str) -> DataFrame:
    """One column of each merchant, to be joined with a rollup by merchant.

    Both sides grow with the merchants, and the rollup is dealt out by key already. Stored
    keys pack so well that Spark would take millions of them for small enough to broadcast,
    which the driver has to hold.
    """
    return merchants.select("merchant_key", column).hint("merge")


def daily(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Rollup per calendar day, with the calendar columns (one row per day at any scale)."""
    return rollup(fact, "date_key").join(dates, "date_key")


def dbl(name: str | Column) -> Column:
    return (F.col(name) if isinstance(name, str) else name).cast("double")


def percent_text(part: Column, total: Column) -> Column:
    """``12.34%`` of two counts or two amounts, rounded once on the exact quotient."""
    return F.concat(C.quotient2(100 * C.whole(part), C.whole(total)).cast("string"), F.lit("%"))


def _change(part: Column, total: Column, prior_part: Column, prior_total: Column) -> tuple[Column, Column]:
    """Change of a share of counts in basis points, as a quotient of two whole numbers."""
    counts = [c.cast("decimal(18,0)") for c in (part, total, prior_part, prior_total)]
    part, total, prior_part, prior_total = counts
    change = (part * prior_total - prior_part * total).cast("decimal(32,0)") * 10000
    return change, (total * prior_total).cast("decimal(36,0)")


def _two_digits(amount: Column) -> Column:
    """An exact decimal amount with two decimals."""
    return F.round(amount, 2).cast("decimal(38,2)").cast("string")


def direction(change: Column) -> Column:
    """Risk direction: the sign of the change in fraud rate."""
    return (
        F.when(change < 0, "Improving").when(change > 0, "Worsening")
        .when(change == 0, "Stable")
    )


# ------------------------------------------------------------ portfolio measures


def portfolio(fact: DataFrame) -> DataFrame:
    """One row with the core measures of the fact rows given."""
    row = fact.agg(*_basics())
    return row.select(
        F.col("n").alias("transaction_count"),
        dbl("amount").alias("total_transaction_amount"),
        C.ratio(F.col("amount"), F.col("n")).alias("average_transaction_amount"),
        F.col("frauds").alias("fraud_transaction_count"),
        C.ratio(F.col("frauds"), F.col("n")).alias("fraud_rate"),
        dbl("exposure").alias("fraud_exposure"),
        C.ratio(F.col("exposure"), F.col("frauds")).alias("average_fraud_transaction_amount"),
        F.col("errors").alias("error_transaction_count"),
        C.ratio(F.col("errors"), F.col("n")).alias("error_rate"),
        (1 - C.ratio(F.col("errors"), F.col("n"))).alias("error_free_rate"),
        C.ratio(F.col("exposure"), F.col("amount")).alias("fraud_exposure_rate"),
    )


def prior_year_dates(selected: DataFrame, group: Iterable[str] = ()) -> DataFrame:
    """The selected days moved back one year, each target day once per group.

    29 February moves to 28 February, as does 28 February itself.
    """
    return selected.select(
        *group, F.add_months("full_date", -12).alias("full_date")
    ).distinct()


def _year_over_year(days: DataFrame, dates: DataFrame) -> DataFrame:
    """Per calendar year: sums of its days and of its days moved back one year.

    Every day counts for its own year and, as a prior-year day, for the year whose
    shifted days include it. Both come from one pass, so the fact is scanned once.
    """
    shifted = prior_year_dates(
        dates.select(F.col("calendar_year").alias("_later_year"), "full_date"), ["_later_year"]
    )
    uses = F.array(
        F.struct(F.col("calendar_year").alias("year"), F.lit(True).alias("own")),
        F.struct(F.col("_later_year").alias("year"), F.lit(False).alias("own")),
    )
    names = ("n", "amount", "frauds", "errors", "exposure")
    return (
        days.join(shifted, "full_date", "left")
        .select(F.inline(uses), "full_date", *names)
        .where(F.col("year").isNotNull())
        .groupBy(F.col("year").alias("calendar_year"))
        .agg(
            *[F.sum(F.when(F.col("own"), F.col(name))).alias(name) for name in names],
            *[F.sum(F.when(~F.col("own"), F.col(name))).alias(f"prior_{name}") for name in names],
            F.max(F.when(F.col("own"), F.col("full_date"))).alias("covered"),
        )
        .where(F.col("n").isNotNull())
    )


def kpi_controls(
    fact: DataFrame, dates: DataFrame, selected: DataFrame | None = None
) -> DataFrame:
    """One row of twelve exact controls over the selected days (default: all days).

    The prior-year amount looks outside the selection, so ``fact`` is not restricted
    to it.
    """
    selected = dates if selected is None else selected
    chosen = selected.select("full_date", F.lit(True).alias("_chosen"))
    earlier = prior_year_dates(selected).withColumn("_earlier", F.lit(True))
    days = (
        daily(fact, dates)
        .join(chosen, "full_date", "left")
        .join(earlier, "full_date", "left")
    )
    row = days.agg(
        *[
            F.sum(F.when(F.col("_chosen"), F.col(name))).alias(name)
            for name in ("n", "amount", "frauds", "errors", "exposure")
        ],
        F.sum(F.when(F.col("_earlier"), F.col("amount"))).alias("prior_amount"),
    )
    amount, before = F.col("amount"), F.col("prior_amount")
    return row.select(
        F.col("n").alias("transaction_count"),
        dbl("amount").alias("total_transaction_amount"),
        C.ratio(amount, F.col("n")).alias("average_transaction_amount"),
        F.col("frauds").alias("fraud_transaction_count"),
        C.ratio(F.col("frauds"), F.col("n")).alias("fraud_rate"),
        dbl("exposure").alias("fraud_exposure"),
        C.ratio(F.col("exposure"), F.col("frauds")).alias("average_fraud_transaction_amount"),
        F.col("errors").alias("error_transaction_count"),
        C.ratio(F.col("errors"), F.col("n")).alias("error_rate"),
        (1 - C.ratio(F.col("errors"), F.col("n"))).alias("error_free_rate"),
        dbl(before).alias("prior_year_transaction_amount"),
        C.ratio(amount - before, before).alias("amount_yoy_growth"),
    )


def yoy_by_year(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Amount and count of each year beside the prior year, with growth."""
    both = _year_over_year(daily(fact, dates), dates)
    return both.select(
        "calendar_year",
        F.col("n").alias("transaction_count"),
        F.col("prior_n").alias("prior_year_transaction_count"),
        C.ratio(F.col("n") - F.col("prior_n"), F.col("prior_n"))
        .alias("transaction_count_yoy_growth"),
        dbl("amount").alias("total_transaction_amount"),
        dbl("prior_amount").alias("prior_year_transaction_amount"),
        C.ratio(F.col("amount") - F.col("prior_amount"), F.col("prior_amount"))
        .alias("amount_yoy_growth"),
    ).orderBy("calendar_year")


def rate_changes_by_year(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Fraud and error rates of each year, their change in basis points, risk direction."""
    both = _year_over_year(daily(fact, dates), dates)
    rates = both.select(
        "calendar_year",
        C.ratio(F.col("frauds"), F.col("n")).alias("fraud_rate"),
        C.ratio(F.col("prior_frauds"), F.col("prior_n")).alias("prior_year_fraud_rate"),
        C.ratio(F.col("errors"), F.col("n")).alias("error_rate"),
        C.ratio(F.col("prior_errors"), F.col("prior_n")).alias("prior_year_error_rate"),
        C.ratio(F.col("exposure"), F.col("amount")).alias("fraud_exposure_rate"),
    )
    return rates.withColumns({
        "fraud_rate_change_bps": (F.col("fraud_rate") - F.col("prior_year_fraud_rate")) * 10000,
        "error_rate_change_bps": (F.col("error_rate") - F.col("prior_year_error_rate")) * 10000,
    }).withColumn(
        "risk_direction", direction(F.col("fraud_rate_change_bps"))
    ).orderBy("calendar_year")


# ------------------------------------------------------------- context and briefs


def selected_date_range(dates: DataFrame) -> DataFrame:
    """First and last selected day as ``MMM d, yyyy - MMM d, yyyy``."""
    return dates.agg(
        F.concat_ws(
            " - ",
            F.date_format(F.min("full_date"), "MMM d, yyyy"),
            F.date_format(F.max("full_date"), "MMM d, yyyy"),
        ).alias("selected_date_range")
    )


def data_coverage(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Last calendar day that has transactions."""
    last = fact.agg(F.max("date_key").alias("date_key"))
    return last.join(dates, "date_key").select(F.col("full_date").alias("data_coverage_date"))


def executive_briefs(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Per year: the decision summary and the risk brief as text, with their inputs."""
    both = _year_over_year(daily(fact, dates), dates)
    fraud = C.ratio(F.col("frauds"), F.col("n"))
    fraud_change = (fraud - C.ratio(F.col("prior_frauds"), F.col("prior_n"))) * 10000
    risk = F.coalesce(direction(fraud_change), F.lit("No prior year"))

    def or_none(text: Column) -> Column:
        return F.coalesce(text, F.lit("n/a"))

    # Dividends, then quotients, are columns of their own: each is computed once, however
    # often the texts name it.
    quotients = {
        name: _change(*[F.col(c) for c in (name, "n", f"prior_{name}", "prior_n")])
        for name in ("frauds", "errors")
    }
    both = both.withColumns({
        "_risk": risk, "_growth": F.col("amount") - F.col("prior_amount"),
        **{f"_{name}_change": above for name, (above, _) in quotients.items()},
        **{f"_{name}_base": below for name, (_, below) in quotients.items()},
    }).withColumns({
        f"_{name}_text": or_none(C.quotient2(F.col(f"_{name}_change"), F.col(f"_{name}_base")).cast("string"))
        for name in quotients
    })
    risk, fraud_text, error_text = (F.col(c) for c in ("_risk", "_frauds_text", "_errors_text"))

    return both.select(
        "calendar_year",
        risk.alias("risk_direction"),
        F.concat(
            F.lit("Risk "), risk,
            F.lit(" | Amount growth "), or_none(percent_text(F.col("_growth"), F.col("prior_amount"))),
            F.lit(" | Fraud rate "), fraud_text,
            F.lit(" bps | Error rate "), error_text,
            F.lit(" bps | Data through "), F.date_format("covered", "yyyy-MM-dd"),
        ).alias("executive_decision_summary"),
        F.concat(
            F.lit("Risk "), risk,
            F.lit(" | Fraud rate "), percent_text(F.col("frauds"), F.col("n")),
            F.lit(" ("), fraud_text,
            F.lit(" bps) | Exposure $"), or_none(_two_digits(F.col("exposure"))),
            F.lit(" | Error rate "), percent_text(F.col("errors"), F.col("n")),
            F.lit(" ("), error_text, F.lit(" bps)"),
        ).alias("risk_exceptions_brief"),
    ).orderBy("calendar_year")


# --------------------------------------------------------------- trends and mixes


def monthly_trend(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Number and value of transactions per calendar month."""
    return (
        daily(fact, dates)
        .groupBy("calendar_year_month", "calendar_year_month_sort").agg(*_sums())
        .select(
            "calendar_year_month", "calendar_year_month_sort",
            F.col("n").alias("transaction_count"),
            dbl("amount").alias("total_transaction_amount"),
        )
        .orderBy("calendar_year_month_sort")
    )


def fraud_error_trend(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Fraud and error events per calendar month."""
    return (
        daily(fact, dates)
        .groupBy("calendar_year_month", "calendar_year_month_sort").agg(*_sums())
        .select(
            "calendar_year_month", "calendar_year_month_sort",
            F.col("frauds").alias("fraud_transaction_count"),
            F.col("errors").alias("error_transaction_count"),
        )
        .orderBy("calendar_year_month_sort")
    )


def method_mix(fact: DataFrame) -> DataFrame:
    """Share of each payment method; there are four method codes, so the total is cheap."""
    return (
        rollup(fact, "transaction_method")
        .withColumn("total", F.sum("n").over(Window.partitionBy(F.lit(1))))
        .select(
            "transaction_method",
            F.col("n").alias("transaction_count"),
            C.ratio(F.col("n"), F.col("total")).alias("transaction_share"),
        )
        .orderBy(F.desc("transaction_count"), "transaction_method")
    )


def error_breakdown(fact: DataFrame) -> DataFrame:
    """Failed transactions by error text."""
    return (
        fact.where(F.col("has_error"))
        .groupBy("transaction_error").agg(F.count(F.lit(1)).alias("error_transaction_count"))
        .orderBy(F.desc("error_transaction_count"), "transaction_error")
    )


# ------------------------------------------------------------------- merchant risk


def fraud_by_category(fact: DataFrame, merchants: DataFrame) -> DataFrame:
    """Fraud per merchant category; the category comes from the merchant table."""
    per_merchant = rollup(fact.where(F.col("is_fraud")), "merchant_key")
    return (
        per_merchant.join(_by_key(merchants, "merchant_category_code"), "merchant_key")
        .groupBy("merchant_category_code").agg(*_sums())
        .select(
            "merchant_category_code",
            F.col("frauds").alias("fraud_transaction_count"),
            dbl("exposure").alias("fraud_exposure"),
        )
        .orderBy(
            F.desc("fraud_transaction_count"),
            F.col("merchant_category_code").asc_nulls_last(),
        )
    )


def _fraud_merchants(fact: DataFrame) -> DataFrame:
    return rollup(fact.where(F.col("is_fraud")), "merchant_key")


def top_fraud_merchants(
    fact: DataFrame, merchants: DataFrame, rows: int = TOP_MERCHANTS
) -> DataFrame:
    """Merchants with the largest fraud exposure, picked before the merchant join."""
    top = _fraud_merchants(fact).orderBy(F.desc("exposure"), "merchant_key").limit(rows)
    return (
        merchants.join(F.broadcast(top), "merchant_key")
        .select(
            "merchant_display_label", "merchant_id_text",
            F.col("frauds").alias("fraud_transaction_count"),
            dbl("exposure").alias("fraud_exposure"),
        )
        .orderBy(F.desc("fraud_exposure"), "merchant_display_label")
    )


def exposure_concentration(fact: DataFrame, rows: int = TOP_MERCHANTS) -> DataFrame:
    """One row: merchants with fraud, total and top exposure, share, and a summary text."""
    total = rollup(fact, "merchant_key").agg(
        C.count_where(F.col("frauds") > 0).alias("fraudulent_merchant_count"),
        F.sum("exposure").alias("total_exposure"),
        F.sum("frauds").alias("frauds"),
        F.sum("n").alias("n"),
    )
    top = (
        _fraud_merchants(fact).orderBy(F.desc("exposure"), "merchant_key").limit(rows)
        .agg(F.sum("exposure").alias("top_exposure"))
    )
    share = C.ratio(F.col("top_exposure"), F.col("total_exposure"))
    rate = C.ratio(F.col("frauds"), F.col("n"))
    return one_row(total, top).select(
        "fraudulent_merchant_count",
        dbl("total_exposure").alias("fraud_exposure"),
        dbl("top_exposure").alias("top_10_fraud_exposure"),
        share.alias("top_10_fraud_exposure_share"),
        rate.alias("portfolio_fraud_rate"),
        F.concat(
            F.col("fraudulent_merchant_count").cast("string"),
            F.lit(" merchants with fraud | Top 10 hold "),
            F.coalesce(percent_text(F.col("top_exposure"), F.col("total_exposure")), F.lit("n/a")),
            F.lit(" of $"), F.coalesce(_two_digits(F.col("total_exposure")), F.lit("0.00")),
            F.lit(" exposure | Portfolio fraud rate "),
            F.coalesce(percent_text(F.col("frauds"), F.col("n")), F.lit("n/a")),
        ).alias("merchant_risk_summary"),
    )


def risk_tier(rate: Column, share: Column) -> Column:
    """Tier by fraud rate, one step higher for a large share of all exposure."""
    level = (
        F.when(rate >= CRITICAL_RATE, 3).when(rate >= HIGH_RATE, 2)
        .when(rate > 0, 1).otherwise(0)
    )
    raised = F.least(level + (F.coalesce(share, F.lit(0.0)) >= LARGE_SHARE).cast("int"), F.lit(3))
    return F.element_at(F.array(*[F.lit(name) for name in TIERS]), raised + 1)


def merchant_risk(fact: DataFrame, merchants: DataFrame) -> DataFrame:
    """Every merchant with fraud rate, exposure, share of exposure, rank, tier and insight.

    The fact is read once: the rollup is stored, and total, ranks and rows come from it.
    Ranks come from a distributed ranking, not from a window over all merchants.
    """
    per_merchant = stage(rollup(fact, "merchant_key"), "merchant-rollup")
    total = per_merchant.agg(F.sum("exposure")).scalar()
    ranked = keys.competition_rank(per_merchant, "exposure", "exposure_rank")
    rate = C.ratio(F.col("frauds"), F.col("n"))
    share = C.ratio(F.col("exposure"), total)
    share_text = percent_text(F.col("exposure"), total)
    scored = ranked.select(
        "merchant_key",
        F.col("n").alias("transaction_count"),
        F.col("frauds").alias("fraud_transaction_count"),
        rate.alias("fraud_rate"),
        dbl("exposure").alias("fraud_exposure"),
        share.alias("exposure_share"),
        share_text.alias("share_text"),
        "exposure_rank",
    ).withColumn("risk_tier", risk_tier(F.col("fraud_rate"), F.col("exposure_share")))
    insight = F.when(
        F.col("fraud_transaction_count") > 0,
        F.concat(
            F.col("risk_tier"), F.lit(" | Rank "), F.col("exposure_rank").cast("string"),
            F.lit(" | Fraud rate "),
            percent_text(F.col("fraud_transaction_count"), F.col("transaction_count")),
            F.lit(" | Exposure share "),
            F.coalesce("share_text", F.lit("n/a")),
        ),
    ).otherwise("No fraud recorded")
    return (
        scored.join(_by_key(merchants, "merchant_display_label"), "merchant_key")
        .withColumn("risk_insight", insight)
        .drop("merchant_key", "share_text")
    )


def merchant_vs_portfolio(
    fact: DataFrame, merchants: DataFrame, label: str | None = None
) -> DataFrame:
    """Fraud rate of each merchant (or one) beside that of the whole date selection.

    The portfolio rate ignores the merchant selection but keeps every other filter.
    """
    whole = fact.agg(C.ratio(C.count_where(F.col("is_fraud")), F.count(F.lit(1)))).scalar()
    own = fact
    if label is not None:
        own = own.where(F.col("merchant_key") == serving.merchant_key_of(label))
    return (
        rollup(own, "merchant_key")
        .join(_by_key(merchants, "merchant_display_label"), "merchant_key")
        .select(
            "merchant_display_label",
            C.ratio(F.col("frauds"), F.col("n")).alias("selected_merchant_fraud_rate"),
            whole.alias("portfolio_fraud_rate"),
        )
    )


def profile_text() -> Column:
    """Label, exact source id, city (or ONLINE), state, postal code and category."""
    return F.concat(
        F.col("merchant_display_label"),
        F.lit("  |  Source ID "), F.col("merchant_id_text"),
        F.lit("  |  "), F.coalesce(F.col("merchant_city"), F.lit("ONLINE")),
        F.coalesce(F.concat(F.lit(", "), F.col("merchant_state")), F.lit("")),
        F.coalesce(F.concat(F.lit(" "), F.col("merchant_zip_code")), F.lit("")),
        F.lit("  |  Category "),
        F.coalesce(F.col("merchant_category_code").cast("string"), F.lit("")),
    )


def merchant_profiles(merchants: DataFrame) -> DataFrame:
    return merchants.select(
        "merchant_display_label", profile_text().alias("selected_merchant_profile")
    )


def selected_merchant_profile(selection: DataFrame) -> DataFrame:
    """One row: the profile when exactly one merchant is selected, else a prompt."""
    return selection.select("merchant_display_label", profile_text().alias("text")).agg(
        F.when(
            F.count(F.lit(1)) == 1, F.max("text")
        ).otherwise(PROFILE_PROMPT).alias("selected_merchant_profile")
    )


def top_merchant_label(fact: DataFrame) -> str | None:
    """Label of the merchant with the largest fraud exposure (one row to the driver)."""
    top = (
        _fraud_merchants(fact).orderBy(F.desc("exposure"), "merchant_key")
        .select(serving.merchant_label(F.col("merchant_key")).alias("label")).first()
    )
    return top["label"] if top else None


def evidence_ledger(
    fact: DataFrame, dates: DataFrame, merchants: DataFrame, label: str | None
) -> DataFrame:
    """All transactions of one merchant with their cell colours, newest first.

    The label holds the merchant key, so the filter reaches the scans of both tables
    and the merchant side is a single row.
    """
    key = serving.merchant_key_of(label) if label is not None else None
    own = fact.where(F.col("merchant_key") == F.lit(key).cast("bigint"))
    merchant = merchants.where(F.col("merchant_key") == F.lit(key).cast("bigint"))
    return (
        own.join(F.broadcast(merchant), "merchant_key")
        .join(dates.select("date_key", "full_date"), "date_key")
        .select(
            "merchant_display_label", "transaction_key", "full_date",
            "transaction_timestamp", dbl("transaction_amount").alias("transaction_amount"),
            "transaction_method", "transaction_error", "is_fraud", "has_error",
            F.when(F.col("is_fraud"), FRAUD_COLOR).otherwise(PLAIN_COLOR)
            .alias("fraud_cell_color"),
            F.when(F.col("has_error"), ERROR_COLOR).otherwise(PLAIN_COLOR)
            .alias("error_cell_color"),
        )
        .orderBy(F.desc("transaction_timestamp"), F.desc("transaction_key"))
    )
