"""The registered queries: every report and operator over the sample tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cardlake import contracts, oracle
from cardlake.functions import columns as C
from cardlake.operators import (
    gold, ingest, profiling, publication, quality, serving, silver,
)
from cardlake.plans import measures, pipeline, reports, views
from cardlake.plans.lakehouse import SAMPLE_PROCESSED_AT, Lakehouse, lakehouse
from cardlake.session import stage, staged_tables, staging_path
from cardlake.sources import files, landing, ledger, sample_landing, tables

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Same rows in types every engine shares: bigint, double, text and boolean."""
    def convert(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.IntegralType):
            column = column.cast("bigint")
        elif isinstance(field.dataType, (T.DecimalType, T.FractionalType)):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        return column.alias(field.name)

    return df.select(*[convert(field) for field in df.schema])


def query(function: Callable[[Lakehouse], DataFrame]) -> Callable[[Lakehouse], DataFrame]:
    """Register a function of the stored layers under its own name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(function(lakehouse(spark, sf_dir)))

    _QUERIES[function.__name__] = run
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def settled(house: Lakehouse, row: DataFrame) -> DataFrame:
    """A result of few rows, computed at once.

    Grouping nearly unique keys takes a task many times the bytes it scans: scans are cut
    small for it, which holds for jobs that run inside the block only.
    """
    with house.sized():
        return stage(row, "settled")


SELECTION = {"years": oracle.YEARS, "methods": oracle.METHODS}


# ---------------------------------------------------------------------- silver


@query
def silver_clean(house):
    return house.silver.select(*silver.SILVER_COLUMNS[:12])


@query
def quarantine_rows(house):
    audit = [name for name in silver.QUARANTINE_COLUMNS if name.startswith("_")]
    return house.quarantine.drop(*audit)


@query
def quarantine_reason_counts(house):
    return house.quarantine.groupBy("quarantine_reason").agg(
        F.count(F.lit(1)).alias("quarantined_rows")
    )


@query
def silver_reconciliation(house):
    return silver.reconcile(house.bronze, house.silver, house.quarantine)


@query
def silver_audit(house):
    """Rows by the moment that silver was processed."""
    stored = silver.read_silver(house.spark, house.silver_path)
    return stored.groupBy(F.col("_silver_processed_at_utc").alias("processed_at")).agg(
        F.count(F.lit(1)).alias("rows"))


# ------------------------------------------------------------------------ gold


@query
def dim_merchant(house):
    return house.merchants


@query
def dim_date(house):
    return house.dates


@query
def fact_transaction(house):
    return house.fact.select(*gold.FACT_COLUMNS[:11])


@query
def gold_validation(house):
    expected = house.silver.agg(F.count(F.lit(1)).alias("expected_fact_rows"))
    return settled(house, quality.gold_controls(house.merchants, house.dates, house.fact, expected))


@query
def analytics_validation(house):
    return settled(house, quality.analytics_controls(house.merchants, house.dates, house.fact))


@query
def model_faults(house):
    """The controls of models with one fault each: fraud rows of unknown merchants, rows with
    an error twice, keys left out, and a calendar without weekends."""
    fact = house.fact.select("transaction_key", "merchant_key", "date_key", "is_fraud", "transaction_error")
    has_error = C.has_error(F.col("transaction_error"))
    faulty = {
        "orphans": fact.withColumn("merchant_key", F.when(F.col("is_fraud"), -F.col("merchant_key"))
                                   .otherwise(F.col("merchant_key"))),
        "repeated": fact.union(fact.where(has_error)),
        "missing": fact.withColumn("transaction_key", F.when(~has_error, F.col("transaction_key")))
        .withColumn("merchant_key", F.when(~F.col("is_fraud"), F.col("merchant_key"))),
        "lost days": fact,
    }
    parts = []
    for fault, df in faulty.items():
        dates = house.dates.where("NOT is_weekend") if fault == "lost days" else house.dates
        parts.append(quality.gold_controls(house.merchants, dates, df).select(
            F.lit(fault).alias("fault"), "merchant_rows", "date_rows", "actual_fact_rows",
            "duplicate_transaction_keys", "missing_transaction_keys", "invalid_merchant_foreign_keys",
            "invalid_date_foreign_keys", "is_valid"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return settled(house, result)


@query
def layer_builds(house):
    """What the builds of gold, views and reporting tables report, each from stored tables."""
    spark, place = house.spark, staging_path(house.spark, "builds")
    paths = [f"{place}/{name}" for name in ("dim_merchant", "dim_date", "fact_transaction")]
    built = gold.build_gold(spark, house.silver_path, *paths)
    with house.sized():
        viewed = views.build_views(spark, *paths)
        served = serving.build_serving(spark, *paths, f"{place}/serving")
    rows = [
        ("gold", built["status"], built["merchant_rows_written"], built["date_rows_written"],
         built["transaction_rows_written"], "", built["persisted_validation"]["is_valid"]),
        ("views", viewed["status"], *[viewed["validation"][f"{n}_rows"] for n in ("merchant", "date", "transaction")],
         ",".join(sorted(viewed["views_created"])), viewed["validation"]["is_valid"]),
        ("serving", served["status"],
         *[served["persisted_validation"][f"{n}_rows"] for n in ("merchant", "date", "transaction")],
         "", served["validation"]["is_valid"]),
    ]
    return spark.createDataFrame(
        rows, "layer string, status string, merchant_rows bigint, date_rows bigint, transaction_rows bigint, "
        "views string, is_valid boolean")


# ----------------------------------------------------------------------- views


@query
def kpi_scalars(house):
    """The platform KPIs as plain numbers by name."""
    _view("vw_platform_kpis")(house)
    found = views.read_platform_kpis(house.spark)
    return house.spark.createDataFrame(
        [(name, float(value)) for name, value in sorted(found.items())], "name string, value double")


def _view(name: str):
    def run(house):
        views.create_views(
            house.spark, house.merchants, house.dates, house.fact.drop(gold.FACT_YEAR)
        )
        return house.spark.table(name)
    return run


@query
def platform_kpis(house):
    return _view("vw_platform_kpis")(house)


@query
def method_summary(house):
    return _view("vw_transaction_method_summary")(house)


@query
def annual_summary(house):
    return _view("vw_annual_transaction_summary")(house)


@query
def view_reconciliation(house):
    _view("vw_platform_kpis")(house)
    return views.view_reconciliation(house.spark)


# ------------------------------------------------------------ reporting tables


@query
def bi_dim_date(house):
    return house.serving["date"]


@query
def bi_dim_merchant(house):
    return house.serving["merchant"]


@query
def bi_fact(house):
    return house.serving["transaction"].drop(gold.FACT_YEAR)


@query
def bi_controls(house):
    source = {"merchant": house.merchants, "date": house.dates, "transaction": house.fact}
    return settled(house, serving.serving_controls(source, house.serving, house.controls))


# ------------------------------------------------------------------- dashboard


@query
def years(house):
    return reports.years(house.dates)


@query
def methods(house):
    return reports.methods(house.fact)


@query
def kpis_filtered(house):
    return reports.kpis(house.fact, house.dates, **SELECTION)


@query
def kpis_empty_selection(house):
    return reports.kpis(house.fact, house.dates, methods=["NO SUCH METHOD"])


@query
def annual_filtered(house):
    return reports.annual_summary(house.fact, house.dates, **SELECTION)


@query
def method_filtered(house):
    return reports.method_summary(house.fact, house.dates, **SELECTION)


@query
def fraud_by_method(house):
    return reports.fraud_by_method(house.fact, house.dates)


@query
def fraud_by_year(house):
    return reports.fraud_by_year(house.fact, house.dates)


@query
def top_states(house):
    return reports.top_states(house.fact, house.dates, house.merchants)


@query
def top_categories(house):
    return reports.top_categories(house.fact, house.dates)


@query
def latest_transactions(house):
    return reports.latest_transactions(house.fact, house.dates, house.merchants)


@query
def fraud_by_method_filtered(house):
    return reports.fraud_by_method(house.fact, house.dates, **SELECTION)


@query
def fraud_by_year_filtered(house):
    return reports.fraud_by_year(house.fact, house.dates, **SELECTION)


@query
def top_states_filtered(house):
    return reports.top_states(house.fact, house.dates, house.merchants, **SELECTION)


@query
def top_categories_filtered(house):
    return reports.top_categories(house.fact, house.dates, **SELECTION)


@query
def latest_transactions_filtered(house):
    return reports.latest_transactions(house.fact, house.dates, house.merchants, **SELECTION)


@query
def exported_sample(house):
    """The latest transactions as written to the CSV sample and read again."""
    report = reports.latest_transactions(house.fact, house.dates, house.merchants)
    path = staging_path(house.spark, "sample")
    reports.write_sample_csv(report, path)
    return house.spark.read.option("header", True).option("escape", '"').csv(path).select(
        F.col("transaction_key").cast("bigint").alias("transaction_key"),
        F.col("transaction_amount").cast("double").alias("transaction_amount"),
        "transaction_method", "merchant_city",
    )


# -------------------------------------------------------------------- measures


@query
def kpi_controls_selected(house):
    """Controls of the selected years beside the days one year earlier."""
    dates = house.serving["date"]
    return measures.kpi_controls(
        house.serving["transaction"], dates, dates.where(F.col("calendar_year").isin(*oracle.YEARS))
    )


@query
def kpi_controls(house):
    return measures.kpi_controls(house.serving["transaction"], house.serving["date"])


@query
def yoy_by_year(house):
    return measures.yoy_by_year(house.serving["transaction"], house.serving["date"])


@query
def rate_bps_by_year(house):
    return measures.rate_changes_by_year(house.serving["transaction"], house.serving["date"])


@query
def executive_summary(house):
    return measures.executive_briefs(house.serving["transaction"], house.serving["date"])


@query
def portfolio_selected(house):
    """The core measures in a filter context of years and methods."""
    selected = reports.select_facts(
        house.serving["transaction"], house.serving["date"], **SELECTION
    )
    return measures.portfolio(selected)


@query
def selected_date_range(house):
    return measures.selected_date_range(house.serving["date"])


@query
def data_coverage(house):
    return measures.data_coverage(house.serving["transaction"], house.serving["date"])


@query
def monthly_trend(house):
    return measures.monthly_trend(house.serving["transaction"], house.serving["date"])


@query
def fraud_error_trend(house):
    return measures.fraud_error_trend(house.serving["transaction"], house.serving["date"])


@query
def method_mix(house):
    return measures.method_mix(house.serving["transaction"])


@query
def error_breakdown(house):
    return measures.error_breakdown(house.serving["transaction"])


@query
def fraud_by_category(house):
    return measures.fraud_by_category(house.serving["transaction"], house.serving["merchant"])


@query
def top_fraud_merchants(house):
    return measures.top_fraud_merchants(house.serving["transaction"], house.serving["merchant"])


@query
def exposure_concentration(house):
    return measures.exposure_concentration(house.serving["transaction"])


@query
def merchant_risk(house):
    return measures.merchant_risk(house.serving["transaction"], house.serving["merchant"])


@query
def merchant_vs_portfolio(house):
    return measures.merchant_vs_portfolio(
        house.serving["transaction"], house.serving["merchant"]
    )


@query
def one_merchant_vs_portfolio(house):
    """The label form, for the merchant with the largest fraud exposure."""
    frames = house.serving
    label = measures.top_merchant_label(frames["transaction"])
    return measures.merchant_vs_portfolio(frames["transaction"], frames["merchant"], label)


@query
def one_merchant_profile(house):
    frames = house.serving
    label = measures.top_merchant_label(frames["transaction"])
    return measures.selected_merchant_profile(
        frames["merchant"].where(F.col("merchant_key") == serving.merchant_key_of(label))
    )


@query
def merchant_profile(house):
    return measures.merchant_profiles(house.serving["merchant"])


@query
def merchant_profile_prompt(house):
    return measures.selected_merchant_profile(house.serving["merchant"])


@query
def evidence_ledger(house):
    frames = house.serving
    label = measures.top_merchant_label(frames["transaction"])
    return measures.evidence_ledger(
        frames["transaction"], frames["date"], frames["merchant"], label
    )


# ------------------------------------------------------------------- profiling


def _landed(house: Lakehouse) -> DataFrame:
    return house.bronze.select(*[f"`{name}`" for name in contracts.TRANSACTIONS.fieldNames()])


@query
def source_shape(house):
    return profiling.shape(_landed(house))


@query
def missing_profile(house):
    return profiling.missing_values(_landed(house))


@query
def distinct_profile(house):
    return profiling.distinct_values(_landed(house))


@query
def value_counts(house):
    return profiling.value_counts(
        _landed(house), ["Use Chip", "Merchant State", "Errors?", "Is Fraud?"]
    )


@query
def column_summary(house):
    return profiling.overview(_landed(house))


@query
def duplicate_rows(house):
    return settled(house, profiling.duplicate_rows(_landed(house)))


@query
def numeric_summary(house):
    landed = _landed(house)
    numbers = [f.name for f in landed.schema if isinstance(f.dataType, T.NumericType)]
    return profiling.numeric_summary(landed, numbers)


@query
def summary(house):
    """Overview of every column, with the numeric summary where it is a number."""
    return profiling.summary(_landed(house))


# ---------------------------------------------------------------- files and ingest


@query
def landing_fingerprints(house):
    """Content hashes of one file per order month, written line by line from the orders."""
    orders = house.spark.read.parquet(f"{house.sf_dir}/orders.parquet")
    folder = staging_path(house.spark, "fingerprints")
    (
        orders.select(
            F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey",
            F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus").alias("value"),
        )
        .repartition("month").sortWithinPartitions("month", "o_orderkey").drop("o_orderkey")
        .write.partitionBy("month").text(folder)
    )
    found = files.Files(house.spark, folder, "*.txt", recursive=True)
    return files.fingerprints(found).select(
        F.regexp_extract("path", r"month=(\d{4}-\d{2})", 1).alias("month"), "size", "sha256",
        F.col("header").alias("first_line"), "is_utf8",
    )


@query
def contract_report(house):
    """Per contract column: whether every file has it, values present, values that fit."""
    contract = contracts.TRANSACTIONS
    folder = house.landing("transactions")
    headers = files.fingerprints(landing.discover(house.spark, folder)).select(
        landing.layouts(F.col("header"), contract)["layout"].alias("layout"))
    found = headers.agg(
        F.count(F.lit(1)).alias("files"),
        *[
            C.count_where(F.array_contains(F.from_json("layout", "array<string>"), name)).alias(f"in_{i}")
            for i, name in enumerate(contract.fieldNames())
        ],
    )
    profile = landing.value_profile(
        landing.scan(house.spark, [folder], contract.fieldNames()), contract
    )
    fits = {"int64": "integers", "float64": "numbers", "str": "present"}
    totals = profile.agg(*[F.sum(name).alias(name) for name in profile.columns[1:]])
    return measures.one_row(totals, found).select(F.inline(F.array(*[
        F.struct(
            F.lit(name).alias("column_name"),
            (F.col(f"in_{i}") == F.col("files")).alias("in_every_file"),
            F.lit(wanted).alias("expected_type"),
            F.col(f"present_{i}").alias("values_present"),
            F.col(f"{fits[wanted]}_{i}").alias("values_fitting"),
        )
        for i, (name, wanted) in enumerate(contracts.expected_types(contract).items())
    ])))


@query
def ingest_idempotency(house):
    """Totals of a first and a second ingest of the same files."""
    paths = house.domain_paths("transactions")["transactions"]
    runs = [ingest.ingest_domain(house.spark, "transactions", paths) for _ in range(2)]
    names = ("status", "files_failed", "rows_read", "rows_written", "bronze_total_rows")
    return house.spark.createDataFrame(
        [
            (run, *[result[name] for name in names],
             result["files_processed"] == result["files_discovered"],
             result["files_skipped"] == result["files_discovered"])
            for run, result in enumerate(runs, 1)
        ],
        "run bigint, status string, files_failed bigint, rows_read bigint, "
        "rows_written bigint, bronze_total_rows bigint, all_processed boolean, "
        "all_skipped boolean",
    )


@query
def ingest_outcomes(house):
    """Status and rows of folders whose files are good, but for one that is broken in one way.

    Every folder holds all sample transactions as written by Spark's tasks, and one more file
    of one record, or header, with the fault. ``again`` ingests the good folder a second time,
    ``legacy`` with a ledger that knows it by name and size only. ``copies`` holds every file
    twice in one batch: one of the two is read.
    """
    spark, contract = house.spark, contracts.TRANSACTIONS
    names = contract.fieldNames()
    quoted = [F.concat(F.lit('"'), F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")), F.lit('"')) for n in names]
    lines = house.bronze.select(F.concat_ws(",", *quoted).alias("line"))
    head = ",".join(names)
    record = ",".join(["1", "3", "1999", "1", "2", "10:00", "$1.00", "Chip Transaction", "5", "{}", "ON", "1.0", "5411", "", "{}"])
    cases = {
        "good": None, "bad_header": (head.replace("MCC", "Code"), record.format("Town", "No")),
        "bad_type": (head, record.format("Town", "No").replace("1999", "now")),
        "surplus_field": (head, record.format("Town", "No") + ",,more"),
        "bad_bytes": (head, record.format("Montr\u00e9al", "No")),
        "unclosed_quote": (head, record.format('"Town', "No")),
        "short_record": (head, "1,3,1999,1,2"), "header_only": (head, None), "copies": None,
    }

    def write(rows: DataFrame, header: str, folder: str) -> None:
        # Without quoting the lines are written as they are.
        (
            rows.toDF(header).write.mode("append").option("header", True).option("sep", "\u0001")
            .option("quote", "\u0000").option("encoding", "ISO-8859-1").csv(folder)
        )

    parts = []
    for case, fault in cases.items():
        # The files and tables of a case are dropped with it: side by side they are ten times the sample.
        with staged_tables(spark):
            folder, place = staging_path(spark, f"outcome-{case}"), staging_path(spark, f"outcome-bronze-{case}")
            write(lines, head, folder)
            if case == "copies":
                write(lines, head, folder)
            if fault:
                records = [(fault[1],)] if fault[1] else []
                write(spark.createDataFrame(records, "line string").coalesce(1), fault[0], folder)
            runs = [ingest.ingest_directory(spark, folder, f"{place}/bronze", f"{place}/ledger", contract)]
            if case == "good":
                runs.append(ingest.ingest_directory(spark, folder, f"{place}/bronze", f"{place}/ledger", contract))
                old = ledger.load(spark, f"{place}/ledger").withColumn("source_file_sha256", F.lit(None).cast("string"))
                old.write.parquet(f"{place}/old_ledger")
                runs.append(ingest.ingest_directory(spark, folder, f"{place}/old_bronze", f"{place}/old_ledger", contract))
            for label, run in zip((case, "again", "legacy"), runs):
                whole = run["files_discovered"] - run["files_failed"]
                read = whole // 2 if label == "copies" else whole
                # All other files share one outcome, or the number of those read is not as it should be.
                status = (
                    ledger.SUCCESS if run["files_processed"] == read and run["files_skipped"] == whole - read
                    else ledger.SKIPPED if run["files_skipped"] == whole else "MIXED"
                )
                parts.append((label, status, run["rows_written"], run["status"] == "PARTIAL_SUCCESS", run["files_failed"]))
    return spark.createDataFrame(
        parts, "case string, status string, rows_written bigint, has_failed boolean, files_failed bigint")


@query
def ledger_upgrade(house):
    """A ledger from before hashing, one row per order, brought to today's columns and asked
    about files of the same names, every second one of the same size."""
    spark = house.spark
    orders = spark.read.parquet(f"{house.sf_dir}/orders.parquet")
    name, size = F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")), F.col("o_orderkey") + 100
    path = staging_path(spark, "old-ledger")
    orders.select(
        name.alias("source_file_name"), size.alias("source_file_size_bytes"),
        F.when(F.col("o_orderstatus") == "F", ledger.SUCCESS).otherwise(ledger.FAILED).alias("status"),
    ).write.parquet(path)
    upgraded = ledger.load(spark, path)
    listed = orders.select(
        name.alias("name"), (size + F.col("o_orderkey") % 2).alias("size"), F.sha2(name, 256).alias("sha256"))
    asked = ledger.mark_processed(listed, upgraded).join(
        upgraded.select(
            F.col("source_file_name").alias("name"), "status", "source_file_sha256",
            F.col("source_file_size_bytes").alias("known_size")),
        "name")
    return asked.groupBy(
        (F.col("status") == ledger.SUCCESS).alias("succeeded"), (F.col("size") == F.col("known_size")).alias("same_size"),
        "already_processed",
    ).agg(F.count(F.lit(1)).alias("files"), C.count_where(F.col("source_file_sha256").isNull()).alias("files_without_hash"))


@query
def publication_rollback(house):
    """The current version and its rows after publishing, a refused and a failed publication
    and a rollback."""
    spark, root = house.spark, staging_path(house.spark, "published")
    source = {"merchant": house.merchants, "date": house.dates, "transaction": house.fact}
    steps = []

    def note(step: str, problem: str | None = None) -> None:
        published = publication.read_published(spark, root)["transaction"].count()
        steps.append((step, publication.current_version(spark, root), published, problem))

    def attempt(step: str, frames, version: str) -> None:
        try:
            with house.sized():
                publication.publish(spark, frames, root, version, SAMPLE_PROCESSED_AT)
            note(step)
        except ValueError as problem:
            note(step, type(problem).__name__)

    attempt("publish", source, "first")
    attempt("same name again", source | {"transaction": house.fact.where("is_fraud")}, "first")
    orphans = house.fact.withColumn("merchant_key", -F.col("merchant_key"))
    attempt("invalid model", source | {"transaction": orphans}, "second")
    attempt("next", source | {"transaction": house.fact.where("is_fraud")}, "third")
    publication.rollback(spark, root, "first", SAMPLE_PROCESSED_AT)
    note("rollback")
    return spark.createDataFrame(steps, "step string, version string, rows bigint, problem string")


@query
def file_route_reasons(house):
    """Landing files through ingest and cleaning: rows and amount per outcome."""
    paths = house.domain_paths("transactions")["transactions"]
    ingest.ingest_domain(house.spark, "transactions", paths)
    bronze = ingest.read_bronze(house.spark, paths.bronze, contracts.TRANSACTIONS)
    cleaned = silver.clean_transactions(bronze, SAMPLE_PROCESSED_AT)
    return cleaned.groupBy("quarantine_reason").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("transaction_amount").alias("total_transaction_amount"),
        F.count_distinct("_source_sequence", "_source_block_start", "_source_row")
        .alias("positions"),
    )


@query
def domain_ingest(house):
    """Card and user domains, ingested together."""
    result = ingest.ingest_domains(house.spark, house.domain_paths("cards", "users"))
    names = ("domains_discovered", "domains_succeeded", "domains_failed", "files_failed",
             "rows_read", "rows_written")
    return house.spark.createDataFrame(
        [(result["status"], *[result[name] for name in names])],
        "status string, " + ", ".join(f"{name} bigint" for name in names),
    )


@query
def domain_bronze_open(house):
    """Card and user bronze without sensitive columns: rows and columns left."""
    paths = house.domain_paths("cards", "users")
    ingest.ingest_domains(house.spark, paths)
    parts = []
    for name, place in paths.items():
        contract = contracts.REGISTRY[name]
        table = contracts.without_sensitive(
            ingest.read_bronze(house.spark, place.bronze, contract), contract
        )
        contracts.assert_not_exposed(table, name)
        kept = [column for column in contract.fieldNames() if column in table.columns]
        parts.append(table.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("domain"), "rows", F.lit(",".join(kept)).alias("open_columns")
        ))
    return parts[0].unionByName(parts[1])


# ----------------------------------------------------------- publication and runs


@query
def publication_check(house):
    """A published version beside its manifest, before and after one file is changed.

    Rows of each table, rows in the files that the manifest lists, whether listed sizes and
    hashes are those of the stored bytes, and the files found changed once a merchant file
    has been overwritten.
    """
    spark = house.spark
    source = {"merchant": house.merchants, "date": house.dates, "transaction": house.fact}
    root = staging_path(spark, "published")
    controls = house.controls
    with house.sized():
        result = publication.publish(spark, source, root, "first", SAMPLE_PROCESSED_AT, controls)
    listed = spark.read.parquet(result["manifest_path"])
    paths = result["output_paths"]
    stored = None
    for name, path in paths.items():
        part = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
            "pathGlobFilter", "*.parquet").load(path).select(
                F.lit(name).alias("table_name"), "path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("hash"))
        rows = spark.read.parquet(path).groupBy(F.input_file_name().alias("path")).agg(F.count(F.lit(1)).alias("rows"))
        part = part.join(rows.select(F.regexp_replace("path", "^file:/+", "file:/").alias("row_path"), "rows"),
                         F.regexp_replace("path", "^file:/+", "file:/") == F.col("row_path"), "left")
        stored = part if stored is None else stored.unionByName(part)
    compared = listed.join(stored, ["table_name", "path"], "full").groupBy("table_name").agg(
        F.sum("rows").alias("rows_in_listed_files"), F.min(F.col("size") == F.col("bytes")).alias("sizes_agree"),
        F.min(F.col("sha256") == F.col("hash")).alias("hashes_agree"))
    published = publication.read_published(spark, root)
    counts = None
    for name, df in published.items():
        part = df.agg(F.count(F.lit(1)).alias("published_rows")).select(F.lit(name).alias("table_name"), "published_rows")
        counts = part if counts is None else counts.unionByName(part)
    before = stage(counts.join(compared, "table_name"), "manifest-check")
    intact_before = publication.verify_version(spark, root, "first")
    # One data file is overwritten in place.
    victim = listed.where("table_name = 'merchant'").orderBy("path").first()
    tables.write_bytes(spark, victim["path"], b"changed")
    changed = publication.changed_files(listed, publication.manifest(spark, paths)).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("changed_files"))
    return before.join(changed, "table_name", "left").select(
        "*", F.lit(intact_before).alias("intact_before"),
        F.lit(publication.verify_version(spark, root, "first")).alias("intact_after"),
    ).fillna(0, ["changed_files"])


@query
def staged_job(house):
    """The run ledger after a good run, one stopped by a gate, one whose driver was lost, and
    another good one, with the rows of the version each left published."""
    spark, root = house.spark, staging_path(house.spark, "job")
    layout = pipeline.Layout(root)
    users = f"{root}/landing/users"
    sample_landing.write(sample_landing.transactions(house.bronze), f"{root}/landing/transactions")
    sample_landing.write(sample_landing.cards(spark, house.sf_dir), f"{root}/landing/cards")
    sample_landing.write(sample_landing.users(spark, house.sf_dir), users)
    pipeline.run_pipeline(spark, root, run_id="1 good")
    tables.rename(spark, users, f"{root}/landing/away")
    try:
        pipeline.run_pipeline(spark, root, run_id="2 gate")
    except RuntimeError:
        pass  # the gate after the ingest of the domains
    started = datetime.now(timezone.utc)
    publication.record_run(
        spark, layout.runs, pipeline=pipeline.PIPELINE_NAME, run_id="3 lost driver",
        status=publication.RUNNING, started=started, recorded=started)
    tables.rename(spark, f"{root}/landing/away", users)
    pipeline.run_pipeline(spark, root, run_id="4 good")
    ends = publication.read_runs(spark, layout.runs).where(F.col("status") != publication.RUNNING)
    versions = None
    for version in ("1 good", "4 good"):
        table = f"{layout.published}/versions/{version}/{serving.TABLE_NAMES['transaction']}.parquet"
        part = spark.read.parquet(table).agg(F.count(F.lit(1)).alias("published_rows")).withColumn(
            "published_version", F.lit(version))
        versions = part if versions is None else versions.unionByName(part)
    return ends.join(versions, "published_version").select(
        "run_id", "status", "recovery_succeeded", "published_version", "published_rows")


@query
def run_freshness(house):
    """Health of every pipeline, each event of a user standing for one pipeline run."""
    events = house.spark.read.parquet(f"{house.sf_dir}/events.parquet")
    stamp = F.col("ts").cast("timestamp")
    runs = events.select(
        F.col("user_id").cast("string").alias("pipeline_name"),
        F.format_string("%012d", F.col("event_id")).alias("run_id"),
        F.when(F.col("event_type") == "error", publication.FAILED)
        .otherwise(publication.SUCCESS).alias("status"),
        stamp.alias("completed_at_utc"),
        stamp.alias("recorded_at_utc"),
    )
    now = events.agg(F.max("ts").cast("timestamp")).scalar()
    return publication.run_health(runs, now, F.lit(True))
