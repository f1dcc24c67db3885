"""Every registered query against its SQL twin, and invariants of the stored layers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import compare
from cardlake import oracle, registry
from cardlake.plans.lakehouse import lakehouse

SF_DIR = "/root/testdata/sf0.001"
SQL = oracle.statements()
QUERIES = registry.queries()


@pytest.fixture(scope="module")
def duckdb():
    return compare.duckdb_connection(SF_DIR)


@pytest.fixture(scope="module")
def house(spark):
    return lakehouse(spark, SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duckdb, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas"):
        assert operator not in plan
    found = compare.spark_result(df)
    assert found[1], "no rows"
    if name in SQL:
        assert compare.difference(found, compare.duckdb_result(duckdb, SQL[name])) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() == 7


def test_keys_are_dense(house):
    for df, key in ((house.merchants, "merchant_key"), (house.fact, "transaction_key")):
        row = df.agg(F.count(key), F.count_distinct(key), F.max(key), F.min(key)).first()
        assert row[0] == row[1] == row[2] and row[3] == 1


def test_year_filter_prunes_directories_and_reaches_the_scan(house):
    from cardlake.plans import reports

    report = reports.kpis(house.fact, house.dates, years=[1998], methods=["CHIP"])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fact_year" in plan
    assert "EqualTo(transaction_method,CHIP)" in plan or "In(transaction_method" in plan
    assert "merchant_key" not in plan  # columns the report does not need are not read


def test_top_values_are_limited_before_the_shuffle(house):
    from cardlake.operators import profiling

    plan = profiling.value_counts(house.bronze, ["MCC"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_silver_scan_reads_one_directory(house):
    plan = house.silver._jdf.queryExecution().executedPlan().toString()
    assert "record_status" in plan and "PartitionFilters" in plan


def test_fact_is_the_same_when_merchants_are_too_many_to_broadcast(house, monkeypatch):
    """The shuffled, salted merchant lookup gives the rows of the broadcast one."""
    from cardlake.operators import gold, lookup

    limit = 600
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", limit)
    index = gold.merchant_index(house.silver)
    hot = index.where(F.col("_transactions") * limit > house.silver.count())
    assert index.count() > limit and 0 < hot.count() < limit
    fact = gold.create_transaction_fact(house.silver, index)
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "CartesianProduct" not in plan
    columns = list(gold.FACT_COLUMNS)
    assert fact.select(columns).exceptAll(house.fact.select(columns)).isEmpty()
    assert fact.count() == house.fact.count()


def test_stored_places_give_the_keys_of_a_window_without_its_shuffle(spark, house):
    from cardlake import contracts
    from cardlake.operators import gold, keys, silver

    placed = silver.read_positioned(spark, f"{house.root}/silver")
    assert set(silver.POSITION) <= set(placed.columns)
    lineage = contracts.LINEAGE.fieldNames()
    wanted = keys.sequence_key(placed, lineage[:2], lineage[2], "k").select(*lineage, "k")
    found = keys.position_key(placed, placed, lineage[:2], lineage[2], *silver.POSITION, "k").select(*lineage, "k")
    assert found.count() == wanted.count() == house.fact.count()
    assert found.exceptAll(wanted).isEmpty()
    plan = gold.create_transaction_fact(placed, gold.merchant_index(placed))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_source_sequence" not in plan
    slow = gold.create_transaction_fact(house.silver, gold.merchant_index(house.silver))
    assert "hashpartitioning(_source_sequence" in slow._jdf.queryExecution().executedPlan().toString()


def test_places_are_not_trusted_where_they_prove_nothing(spark, house, monkeypatch):
    from cardlake import contracts
    from cardlake.operators import keys, silver

    lineage = contracts.LINEAGE.fieldNames()
    placed = silver.read_positioned(spark, f"{house.root}/silver")

    def key(df):
        return keys.position_key(df, df, lineage[:2], lineage[2], *silver.POSITION, "k")

    assert key(placed.where("_silver_row % 2 = 0")) is None  # gaps
    halves = placed.withColumn("_silver_file", F.concat("_silver_file", F.col("_source_row") % 2)).withColumn(
        "_silver_row", F.floor(F.col("_silver_row") / 2))
    assert key(halves) is None  # pieces that overlap
    monkeypatch.setattr(keys, "MAX_PIECES", 0)
    assert key(placed) is None


def test_a_silver_table_changed_later_is_not_taken_as_ordered(spark, house, tmp_path):
    from cardlake.operators import silver

    path = str(tmp_path / "silver")
    cleaned = silver.clean_transactions(house.bronze, F.lit("2026-01-02").cast("timestamp"))
    silver.write_silver(cleaned, path)
    assert silver.is_ordered(spark, path)
    cleaned.limit(0).withColumn(silver.STATUS, F.lit(silver.VALID)).write.mode("append").partitionBy(
        silver.STATUS).parquet(path)
    assert not silver.is_ordered(spark, path)
    assert not set(silver.POSITION) & set(silver.read_positioned(spark, path).columns)
