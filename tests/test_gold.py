from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import Window, functions as F

from cardlake.operators import gold, keys, lookup, quality, silver
from conftest import NOW, rows

SCHEMA = (
    "user_id bigint, card_id bigint, transaction_timestamp timestamp_ntz, "
    "transaction_amount decimal(18,4), transaction_method string, merchant_id bigint, "
    "merchant_city string, merchant_state string, merchant_zip_code string, "
    "merchant_category_code bigint, transaction_error string, is_fraud boolean, "
    "_source_file_name string, _ingestion_timestamp_utc timestamp, _pipeline_run_id string, "
    "_silver_processed_at_utc timestamp"
)


def row(user, card, when, amount, method, merchant, fraud=False, error=None):
    from decimal import Decimal

    return (user, card, when, Decimal(amount), method, *merchant, error, fraud,
            "rows.csv", NOW, "a-run", NOW)


BRNO = (7001, "Brno", "JM", "60200", 5094)
OSLO = (7002, "Oslo", None, "0150", 4111)
WEB = (7001, "ONLINE", None, None, 4111)
SAMPLE = [
    row(5, 51, datetime(2023, 2, 27, 8, 15), "12.10", "SWIPE", OSLO),
    row(5, 52, datetime(2023, 3, 1, 23, 59), "99.99", "CHIP", BRNO, error="Bad PIN"),
    row(6, 61, datetime(2023, 3, 1), "-7.45", "CHIP", BRNO, fraud=True),
]


@pytest.fixture
def sample(spark):
    return spark.createDataFrame(SAMPLE, SCHEMA)


def test_merchants_are_distinct_sorted_and_numbered(spark):
    frame = spark.createDataFrame(
        [*SAMPLE, row(3, 1, datetime(2024, 1, 2), "1", "Online", WEB),
         row(4, 1, datetime(2024, 1, 2), "1", "Online", WEB)], SCHEMA)
    merchants = gold.create_merchant_dimension(frame).orderBy("merchant_key")
    assert rows(merchants, "merchant_key", "merchant_id", "merchant_city") == [
        (1, 7001, "Brno"), (2, 7001, "ONLINE"), (3, 7002, "Oslo")]
    assert merchants.columns == ["merchant_key", *gold.MERCHANT_COLUMNS]


def test_calendar_fills_gaps(sample):
    dates = gold.create_date_dimension(sample).orderBy("date_key")
    assert [r["date_key"] for r in dates.collect()] == [20230227, 20230228, 20230301]
    first = dates.first()
    assert first["full_date"] == date(2023, 2, 27)
    assert (first["calendar_month_name"], first["calendar_day_name"]) == ("February", "Monday")
    assert (first["calendar_day_of_week_number"], first["is_weekend"]) == (1, False)
    assert (first["calendar_year"], first["calendar_quarter"]) == (2023, 1)


def test_weekend_days(spark):
    frame = spark.createDataFrame(
        [row(1, 1, datetime(2024, 1, 5), "1", "Chip", WEB),
         row(1, 1, datetime(2024, 1, 8), "1", "Chip", WEB)], SCHEMA)
    days = gold.create_date_dimension(frame).orderBy("date_key")
    assert [r["is_weekend"] for r in days.collect()] == [False, True, True, False]
    assert [r["calendar_day_of_week_number"] for r in days.collect()] == [5, 6, 7, 1]


def test_calendar_needs_valid_dates(spark):
    with pytest.raises(ValueError, match="empty"):
        gold.create_date_dimension(spark.createDataFrame([], SCHEMA))
    with pytest.raises(ValueError, match="1 timestamps"):
        gold.create_date_dimension(
            spark.createDataFrame([row(1, 1, None, "1", "Chip", WEB)], SCHEMA))


def test_fact_keys_and_columns(sample):
    fact = gold.create_transaction_fact(sample, gold.create_merchant_dimension(sample))
    assert fact.columns == list(gold.FACT_COLUMNS)
    fact = fact.orderBy("transaction_key")
    assert rows(fact, "transaction_key", "date_key", "merchant_key") == [
        (1, 20230227, 2), (2, 20230301, 1), (3, 20230301, 1)]


def test_fact_leaves_out_absent_audit_columns(sample):
    plain = sample.drop("_source_file_name", "_pipeline_run_id")
    fact = gold.create_transaction_fact(plain, gold.create_merchant_dimension(plain))
    assert "_source_file_name" not in fact.columns
    assert "_ingestion_timestamp_utc" in fact.columns


def test_null_merchant_columns_match(spark):
    frame = spark.createDataFrame([row(1, 1, datetime(2024, 1, 1), "1", "Online", WEB)], SCHEMA)
    fact = gold.create_transaction_fact(frame, gold.create_merchant_dimension(frame))
    assert fact.first()["merchant_key"] == 1


def test_repeated_merchants_are_rejected(sample):
    merchants = gold.create_merchant_dimension(sample)
    with pytest.raises(ValueError, match="more than one row"):
        gold.create_transaction_fact(sample, merchants.union(merchants))


def model(sample):
    merchants = gold.create_merchant_dimension(sample)
    return merchants, gold.create_date_dimension(sample), gold.create_transaction_fact(
        sample, merchants)


def expect(spark, n):
    return spark.createDataFrame([(n,)], "expected_fact_rows bigint")


def test_valid_model(spark, sample):
    result = quality.validate_gold(*model(sample), expect(spark, 3))
    assert result["is_valid"] and result["actual_fact_rows"] == 3
    assert (result["merchant_rows"], result["date_rows"]) == (2, 3)


def test_model_faults_are_counted(spark, sample):
    merchants, dates, fact = model(sample)
    broken = fact.withColumn("merchant_key", F.when(
        F.col("transaction_key") == 1, 999999).otherwise(F.col("merchant_key")))
    with pytest.raises(ValueError, match="'invalid_merchant_foreign_keys': 1"):
        quality.validate_gold(merchants, dates, broken, expect(spark, 3))
    with pytest.raises(ValueError, match="'duplicate_transaction_keys': 3"):
        quality.validate_gold(merchants, dates, fact.union(fact), expect(spark, 6))
    with pytest.raises(ValueError, match="'expected_fact_rows': 4"):
        quality.validate_gold(merchants, dates, fact, expect(spark, 4))
    with pytest.raises(ValueError, match="'invalid_date_foreign_keys': 2"):
        quality.validate_gold(
            merchants, dates.where("date_key < 20230301"), fact, expect(spark, 3))
    unkeyed = fact.withColumn("transaction_key", F.lit(None).cast("bigint"))
    with pytest.raises(ValueError, match="'missing_transaction_keys': 3"):
        quality.validate_gold(merchants, dates, unkeyed, expect(spark, 3))


def test_empty_tables_fail_for_readers(spark, sample):
    merchants, dates, fact = model(sample)
    row_ = quality.analytics_controls(merchants, dates, fact.where("false")).first()
    assert not row_["is_valid"] and row_["transaction_rows"] == 0


def test_build_writes_and_checks(spark, sample, tmp_path):
    source = str(tmp_path / "silver")
    sample.withColumn(silver.STATUS, F.lit(silver.VALID)).withColumn(
        "quarantine_reason", F.lit("")).write.partitionBy(silver.STATUS).parquet(source)
    paths = [str(tmp_path / name) for name in ("m", "d", "f")]
    result = gold.build_gold(spark, source, *paths)
    assert (result["merchant_rows_written"], result["date_rows_written"],
            result["transaction_rows_written"]) == (2, 3, 3)
    assert (result["merchant_columns"], result["date_columns"],
            result["transaction_columns"]) == (6, 10, 14)
    assert result["persisted_validation"]["is_valid"]
    with pytest.raises(FileNotFoundError):
        gold.build_gold(spark, str(tmp_path / "none"), *paths)


# --------------------------------------------------------------------- dense keys


@pytest.fixture
def many(spark):
    """Values with ties and nulls, spread over several tasks."""
    return spark.range(0, 5000, 1, 7).select(
        F.when(F.col("id") % 11 != 0, F.col("id") % 97).alias("a"), "id")


@pytest.fixture
def no_coalescing(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def test_dense_key_equals_global_row_number(many, no_coalescing):
    order = [F.col("a").asc_nulls_last(), F.col("id").asc_nulls_last()]
    found = keys.dense_key(many, order, "k")
    assert many.repartitionByRange(*order).rdd.getNumPartitions() > 1
    wanted = many.withColumn("k", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert sorted(rows(found, "k", "id")) == sorted(rows(wanted, "k", "id"))


def test_sequence_key_equals_global_row_number(many):
    blocks = many.select(
        (F.col("id") % 3).alias("s"), (F.col("id") % 7).alias("b"), F.col("id").alias("r"))
    found = keys.sequence_key(blocks, ["s", "b"], "r", "k")
    wanted = blocks.withColumn("k", F.row_number().over(Window.orderBy("s", "b", "r")))
    assert sorted(rows(found, "k", "r")) == sorted(rows(wanted, "k", "r"))


def test_competition_rank_equals_global_rank(many, no_coalescing):
    found = keys.competition_rank(many, "a", "place")
    wanted = many.withColumn("place", F.when(
        F.col("a").isNotNull(), F.rank().over(Window.orderBy(F.col("a").desc_nulls_last()))))
    assert sorted(rows(found.fillna(-1, ["place"]), "id", "place")) == sorted(
        rows(wanted.fillna(-1, ["place"]), "id", "place"))


@pytest.mark.parametrize("broadcast_rows", [1, 3, 20, 100_000])
def test_lookup_with_hot_keys_equals_plain_join(spark, broadcast_rows):
    """One key (null) holds a third of the rows; every strategy gives the same result."""
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 != 0, F.col("id") % 50).alias("k1"),
        F.when(F.col("id") % 3 != 0, F.lit("x")).alias("k2"), "id")
    index = facts.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "value", F.coalesce(F.col("k1"), F.lit(-1)) * 10)
    found = lookup.attach(facts, index, ["k1", "k2"], ["value"], "n", broadcast_rows)
    assert found.columns == ["k1", "k2", "id", "value"]
    wanted = facts.withColumn("value", F.coalesce(F.col("k1"), F.lit(-1)) * 10)
    assert sorted(rows(found, "id", "value")) == sorted(rows(wanted, "id", "value"))


def test_lookup_keeps_rows_without_a_match(spark):
    facts = spark.range(6).select((F.col("id") % 3).alias("k"), "id")
    index = spark.createDataFrame([(0, "a", 2)], "k bigint, value string, n bigint")
    for limit in (1, 0):
        found = lookup.attach(facts, index, ["k"], ["value"], "n", limit)
        assert found.count() == 6 and found.where("value = 'a'").count() == 2


def test_quantiles_equal_numpy(spark, many, no_coalescing):
    import numpy as np

    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    found = {r["column_name"]: r for r in keys.exact_quantiles(
        many, ["a", "id"], probabilities).collect()}
    data = many.toPandas()
    for name in ("a", "id"):
        wanted = np.quantile(data[name].dropna(), probabilities)
        got = [found[name][f"p{round(p * 100)}"] for p in probabilities]
        assert got == pytest.approx(list(wanted))


def test_shuffle_partitions_follow_the_input(spark):
    from cardlake.session import MAX_SHUFFLE_PARTITIONS, shuffles_sized_for

    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with shuffles_sized_for(spark, 0):
        assert spark.conf.get(name) == before
    with pytest.raises(KeyError):
        with shuffles_sized_for(spark, 100 * 1024 ** 3):
            assert spark.conf.get(name) == "3200"
            raise KeyError
    with shuffles_sized_for(spark, 100 * 1024 ** 4):
        assert spark.conf.get(name) == str(MAX_SHUFFLE_PARTITIONS)
    assert spark.conf.get(name) == before


# ------------------------------------------------- clustered files, kept controls, staged tables


def scanned_rows(df):
    """Rows that the scans of a collected frame handed on, after files and row groups were skipped."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    plans = [leaves.apply(i) for i in range(leaves.length())]
    while any(p.nodeName().startswith(("AdaptiveSparkPlan", "ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage"))
              for p in plans):
        opened = []
        for p in plans:
            if p.nodeName().startswith("AdaptiveSparkPlan"):
                opened.append(p.executedPlan())
            elif "QueryStage" in p.nodeName():
                opened.append(p.plan())
            else:
                opened.append(p)
        plans = []
        for p in opened:
            below = p.collectLeaves()
            plans += [below.apply(i) for i in range(below.length())]
    return sum(p.metrics().apply("numOutputRows").value() for p in plans if p.nodeName().startswith("Scan"))


@pytest.fixture
def skewed_fact(spark):
    """Rows of 400 merchants over two years in random order; merchant 7 has a third of them."""
    merchant = F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(400)))
    return spark.range(0, 60_000, 1, 6).select(
        F.col("id").alias("transaction_key"), merchant.cast("bigint").alias("merchant_key"),
        F.when(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)) == 0, 20230105).otherwise(20240207).cast("bigint").alias("date_key"),
        F.sha2(F.col("id").cast("string"), 256).alias("transaction_error"),
    ).repartition(6, F.rand(3))


def test_a_drill_through_skips_row_groups(spark, skewed_fact, tmp_path):
    path = str(tmp_path / "fact")
    gold.write_fact(skewed_fact, path, row_group_bytes=64 * 1024)
    fact = gold.read_fact(spark, path)
    assert sorted(rows(fact, *skewed_fact.columns)) == sorted(rows(skewed_fact, *skewed_fact.columns))
    own = fact.where("merchant_key = 33")
    assert own.count() == skewed_fact.where("merchant_key = 33").count() > 50
    assert scanned_rows(own) < 0.1 * 60_000
    # A plain write keeps every merchant in every row group.
    skewed_fact.write.option("parquet.block.size", 64 * 1024).parquet(str(tmp_path / "plain"))
    plain = spark.read.parquet(str(tmp_path / "plain")).where("merchant_key = 33")
    assert scanned_rows(plain) > 0.5 * 60_000


def test_a_large_merchant_is_spread_over_files(spark, skewed_fact, tmp_path, no_coalescing):
    path = str(tmp_path / "fact")
    gold.write_fact(skewed_fact, path)
    sizes = [r["n"] for r in gold.read_fact(spark, path).groupBy(F.input_file_name()).agg(
        F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) >= 8 and max(sizes) < 60_000 / 3


def test_published_fact_keeps_the_clusters(spark, skewed_fact, tmp_path, monkeypatch):
    from cardlake.operators import serving

    monkeypatch.setattr(gold, "ROW_GROUP_BYTES", 64 * 1024)
    gold.write_fact(skewed_fact, str(tmp_path / "fact"), 64 * 1024)
    paths = serving.write_serving({"transaction": gold.read_fact(spark, str(tmp_path / "fact"))}, str(tmp_path / "out"))
    own = spark.read.parquet(paths["transaction"]).where("merchant_key = 33")
    assert scanned_rows(own) < 0.1 * 60_000


def fact_scans(df):
    """Scans of a table with transaction keys in a plan."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum("[transaction_key#" in leaves.apply(i).toString() or ",transaction_key#" in leaves.apply(i).toString() for i in range(leaves.length()))


def test_controls_scan_the_fact_once(spark, sample, tmp_path):
    from cardlake.operators import serving

    source, paths = str(tmp_path / "silver"), [str(tmp_path / name) for name in ("m", "d", "f")]
    sample.withColumn(silver.STATUS, F.lit(silver.VALID)).withColumn(
        "quarantine_reason", F.lit("")).write.partitionBy(silver.STATUS).parquet(source)
    gold.build_gold(spark, source, *paths)
    merchants, dates, fact = (spark.read.parquet(path) for path in paths)
    assert fact_scans(quality.gold_controls(merchants, dates, fact)) == 1
    assert fact_scans(quality.analytics_controls(merchants, dates, fact)) == 1
    frames = serving.serving_frames(merchants, dates, fact)
    kept = gold.stored_controls(spark, *paths)
    model_ = {"merchant": merchants, "date": dates, "transaction": fact}
    assert fact_scans(serving.serving_controls(model_, frames, kept)) == 1
    assert fact_scans(serving.serving_controls(model_, frames)) == 2
    assert serving.serving_controls(model_, frames, kept).first() == serving.serving_controls(model_, frames).first()


def test_kept_controls_are_dropped_with_their_tables(spark, sample, tmp_path):
    source, paths = str(tmp_path / "silver"), [str(tmp_path / name) for name in ("m", "d", "f")]
    sample.withColumn(silver.STATUS, F.lit(silver.VALID)).withColumn(
        "quarantine_reason", F.lit("")).write.partitionBy(silver.STATUS).parquet(source)
    assert gold.stored_controls(spark, *paths) is None
    gold.build_gold(spark, source, *paths)
    assert gold.stored_controls(spark, *paths).first()["actual_fact_rows"] == 3
    fact = gold.read_fact(spark, paths[2])
    fact.limit(1).write.mode("append").partitionBy(gold.FACT_YEAR).parquet(paths[2])
    assert gold.stored_controls(spark, *paths) is None


def test_missing_keys_and_orphans_are_told_apart(spark):
    merchants = spark.createDataFrame([(1,), (1,), (None,), (None,), (3,)], "merchant_key bigint")
    dates = spark.createDataFrame([(20240101,)], "date_key bigint")
    fact = spark.createDataFrame(
        [(1, 1, 20240101), (1, None, 20240101), (None, 9, None), (None, 3, 20240102)],
        "transaction_key bigint, merchant_key bigint, date_key bigint")
    row = quality.star_controls(merchants, dates, fact, {"keys": F.col("transaction_key")}).first().asDict()
    assert row == {
        "merchant_rows": 5, "duplicate_merchant_keys": 2, "missing_merchant_keys": 2,
        "date_rows": 1, "duplicate_date_keys": 0, "missing_date_keys": 0,
        "actual_fact_rows": 4, "duplicate_transaction_keys": 2, "missing_transaction_keys": 2,
        "invalid_merchant_foreign_keys": 2, "invalid_date_foreign_keys": 2, "keys": 2}
    empty = quality.star_controls(merchants.where("false"), dates.where("false"), fact.where("false")).first()
    assert set(empty.asDict().values()) == {0}


def staged(spark):
    import os

    from cardlake.session import shared_root

    folder = f"{shared_root(spark)}/cardlake/{spark.sparkContext.applicationId}"
    return set(os.listdir(folder)) if os.path.exists(folder) else set()


def test_staged_tables_are_dropped_with_their_block(spark, many):
    from cardlake.session import stage, staged_tables

    before = staged(spark)
    with staged_tables(spark):
        outer = stage(many, "outer")
        with pytest.raises(KeyError), staged_tables(spark):
            inner, kept = stage(many, "inner"), stage(many, "kept", keep=True)
            assert inner.count() == kept.count() == 5000 and len(staged(spark) - before) == 3
            raise KeyError
        assert outer.count() == kept.count() == 5000 and len(staged(spark) - before) == 2
    assert staged(spark) == before


def test_gold_and_merchant_risk_leave_no_staged_table(spark, sample, tmp_path):
    from cardlake.operators import serving
    from cardlake.plans import measures
    from cardlake.session import staged_tables

    paths = [str(tmp_path / name) for name in ("m", "d", "f")]
    before = staged(spark)
    gold.write_gold(sample, *paths)
    frames = serving.serving_frames(*(spark.read.parquet(path) for path in paths))
    with staged_tables(spark):
        measures.merchant_risk(frames["transaction"], frames["merchant"]).write.parquet(str(tmp_path / "risk"))
    assert staged(spark) == before and spark.read.parquet(str(tmp_path / "risk")).count() == 2


def test_old_staged_tables_of_other_applications_expire(spark):
    import os
    import uuid

    from cardlake.session import expire_staged, shared_root

    root = f"{shared_root(spark)}/cardlake"
    old, new = (f"{root}/{name}-{uuid.uuid4().hex}" for name in ("old", "new"))
    for path in (old, new):
        os.makedirs(f"{path}/table")
    for path in (f"{old}/table", old):
        os.utime(path, (1, 1))
    own = staged(spark)
    assert expire_staged(spark, 2) >= 1
    assert not os.path.exists(old) and os.path.exists(new) and staged(spark) == own
