"""Steps whose cost or outcome once depended on how large the tables are."""

from __future__ import annotations

import os
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cardlake import contracts, registry, session
from cardlake.operators import gold, ingest, publication
from cardlake.plans import lakehouse as lakehouse_module, measures, pipeline
from cardlake.sources import files, landing, sample_landing, tables


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _scanned(spark, texts):
    names = contracts.TRANSACTIONS.fieldNames()
    rows = spark.createDataFrame([(text,) for text in texts], "value string")
    return rows.select(
        *[F.col("value").alias(name) for name in names], F.lit(None).cast("string").alias("_corrupt_record"),
        F.lit("a.csv").alias("_file"))


def test_only_texts_of_digits_are_cast_to_whole_numbers(spark):
    """A try_cast that fails costs an exception for each value, tens of microseconds."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = _plan(landing.value_profile(_scanned(spark, ["5"]), contracts.TRANSACTIONS))
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("try_cast(") == plan.count("THEN isnotnull(try_cast(") == len(contracts.TRANSACTIONS)


def test_whole_numbers_are_counted_as_before(spark):
    texts = [
        "5", "+5", "-5", " 5", "5 ", "\t5\n", "5.", "5.0", ".5", "", "+", "-", "1e3", "00012", "--5", "5L", "0x10",
        "9223372036854775807", "9223372036854775808", "-9223372036854775808", "５", "5\x00", "\x7f5", "\x0b5",
        " 5", "5 ", "5\n6", "\x855", "five", None,
    ]
    wanted = sum(
        row["whole"] for row in spark.createDataFrame([(text,) for text in texts], "value string")
        .select(F.col("value").try_cast("bigint").isNotNull().cast("int").alias("whole")).collect())
    found = landing.value_profile(_scanned(spark, texts), contracts.TRANSACTIONS).first()
    assert {found[f"integers_{i}"] for i in range(len(contracts.TRANSACTIONS))} == {wanted}


def test_merchants_are_not_broadcast(spark):
    """They grow with the tables; the driver would have to hold them."""
    fact = spark.range(50).selectExpr(
        "id % 7 + 1 AS merchant_key", "1 AS date_key", "CAST(id AS decimal(18,4)) AS transaction_amount",
        "id % 3 = 0 AS is_fraud", "id % 5 = 0 AS has_error", "'CHIP' AS transaction_method")
    merchants = spark.range(1, 8).selectExpr(
        "id AS merchant_key", "concat('MRC-', id) AS merchant_display_label", "id % 2 AS merchant_category_code")
    found = measures.merchant_vs_portfolio(fact, merchants)
    assert found.count() == 7
    for df in (found, measures.merchant_risk(fact, merchants), measures.fraud_by_category(fact, merchants)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [merchant_key" in plan and "BroadcastHashJoin [merchant_key" not in plan


def test_landing_files_hold_records(spark, tmp_path):
    """A first task without rows leaves a header alone, which no ingest accepts."""
    rows = spark.createDataFrame([("", i) for i in range(40)], "a string, b bigint")
    path = str(tmp_path / "landing")
    parts = rows.rdd.mapPartitionsWithIndex(lambda i, part: part if i else iter(())).toDF(rows.schema)
    sample_landing.write(parts, path)
    sizes = [file.stat().st_size for file in (tmp_path / "landing").glob("*.csv")]
    assert sizes and min(sizes) > len("a,b\n")
    assert spark.read.option("header", True).csv(path).count() == parts.count() > 0

    sample_landing.write(rows.where("b < 0"), str(tmp_path / "empty"))
    assert len(list((tmp_path / "empty").glob("*.csv"))) == 1


def test_a_query_builds_only_the_layers_it_reads(spark):
    house = lakehouse_module._unbuilt(spark, "/root/testdata/sf0.001")
    house.domain_paths("cards", "users")
    assert not tables.exists(spark, f"{house.folder}/bronze")
    assert house.quarantine.count() > 0
    assert tables.exists(spark, f"{house.folder}/silver") and not tables.exists(spark, house.folder + "/dim_merchant")
    assert house.fact.count() == house.silver.count()
    assert gold.stored_controls(spark, *house.gold_paths) is None and house.controls.count() == 1
    assert gold.stored_controls(spark, *house.gold_paths).count() == 1


def test_scans_and_writers_are_set_for_a_block_only(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions", "spark.sql.maxConcurrentOutputFileWriters")
    before = [spark.conf.get(name) for name in names]
    with session.shuffles_sized_for(spark, 64 * session.SHUFFLE_PARTITION_BYTES), session.open_writers(spark, 64):
        assert [spark.conf.get(name) for name in names] == [str(session.SCAN_BYTES), "256", "64"]
        with session.small_scans(spark):
            assert spark.conf.get(names[0]) == str(session.SCAN_BYTES)
    assert [spark.conf.get(name) for name in names] == before


def test_bronze_partitions_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    """Sorting all rows of a task by file spills once tasks read large pieces."""
    seen = []
    write = tables.open_writers
    monkeypatch.setattr(tables, "open_writers", lambda of, files: seen.append(files) or write(of, files))
    rows = spark.range(100).selectExpr("id", "CAST(id % 5 AS string) AS part")
    for _ in range(2):
        tables.append_by_partition(rows, str(tmp_path / "t"), "part")
    assert seen == [tables.OPEN_PARTITIONS] * 2 and spark.read.parquet(str(tmp_path / "t")).count() == 100


def test_controls_are_computed_with_small_scans(spark, monkeypatch):
    """Memory of a task that groups unique keys follows the bytes it scans, up to 128 MB."""
    seen = []
    write = registry.stage
    name = "spark.sql.files.maxPartitionBytes"
    monkeypatch.setattr(registry, "stage", lambda df, label: seen.append(spark.conf.get(name)) or write(df, label))
    for query in ("gold_validation", "analytics_validation", "bi_controls", "duplicate_rows", "model_faults"):
        assert registry.queries()[query](spark, "/root/testdata/sf0.001").count() > 0
    assert seen == [str(session.SCAN_BYTES)] * 5


def test_landing_files_grow_in_number_and_not_in_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sample_landing, "RECORDS_PER_FILE", 10)
    path = str(tmp_path / "landing")
    sample_landing.write(spark.range(95).coalesce(1), path)
    assert len(list((tmp_path / "landing").glob("*.csv"))) == 10
    assert spark.read.option("header", True).csv(path).count() == 95
    assert files.IN_MEMORY_BYTES <= 64 * 1024 * 1024


def test_shuffle_partitions_are_small_and_stay_small(spark):
    """Merged to 64 MB, partitions of keys and counts take a task most of a gigabyte."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(name) for name in names]
    with session.small_shuffles(spark, 1024 ** 3):
        assert int(spark.conf.get(names[0])) >= 256
        assert int(spark.conf.get(names[1])) <= 8 * 1024 * 1024
    assert [spark.conf.get(name) for name in names] == before
    spark.conf.set(names[1], "1000000b")
    try:
        with session.small_shuffles(spark, 1024 ** 3):
            assert spark.conf.get(names[1]) == "1000000b"
    finally:
        spark.conf.set(names[1], before[1])


@pytest.mark.parametrize("query, versions", [("publication_rollback", 4), ("publication_check", 1)])
def test_publication_shuffles_suit_the_tables(spark, monkeypatch, query, versions):
    """The controls group every key of the fact, with the configured partitions however many keys there are."""
    seen = []
    publish = publication.publish
    monkeypatch.setattr(tables, "stored_bytes", lambda *_: 1024 ** 3)
    monkeypatch.setattr(publication, "publish", lambda *args: seen.append(
        (int(spark.conf.get("spark.sql.shuffle.partitions")) >= 256,
         spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))) or publish(*args))
    assert registry.queries()[query](spark, "/root/testdata/sf0.001").count() > 0
    assert seen == [(True, str(session.MERGED_PARTITION_BYTES))] * versions


def test_large_sides_are_not_sorted_for_a_join(spark):
    """Line items were sorted by order, and transactions by five merchant columns, twice each."""
    broadcast = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(broadcast)
    spark.conf.set(broadcast, -1)
    try:
        with session.shuffles_sized_for(spark, 0):
            joined = spark.range(1000).join(spark.range(500).withColumn("x", F.col("id") * 2), "id", "left")
            assert joined.where("x >= 0").count() == 500 and len(joined.collect()) == 1000
            plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set(broadcast, before)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_cases_of_outcomes_do_not_lie_side_by_side(spark, monkeypatch):
    """Each holds all sample rows as landing files and as bronze."""
    seen = []
    root = f"{session.shared_root(spark)}/cardlake/{spark.sparkContext.applicationId}"

    def cases(start="outcome-"):
        return [name for name in os.listdir(root) if name.startswith(start)]

    def read(spark, folder, *_):
        seen.append((set(cases()) - set(cases("outcome-bronze-")), os.path.basename(folder)))
        n = len([name for name in os.listdir(folder) if name.endswith(".csv")])
        return {"files_discovered": n, "files_failed": 0, "files_processed": n, "files_skipped": 0,
                "rows_written": n, "status": "SUCCESS"}

    monkeypatch.setattr(ingest, "ingest_directory", read)
    names = contracts.TRANSACTIONS.fieldNames()
    rows = spark.createDataFrame([tuple("x" for _ in names)] * 4, [f"c{i}" for i in range(len(names))]).toDF(*names)
    found = registry.ingest_outcomes(SimpleNamespace(spark=spark, bronze=rows))
    assert found.count() == 11 and len(seen) == 11
    assert all(there == {folder} for there, folder in seen) and not cases()


SHORT_LIVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_shuffles_of_a_build_end_with_their_job(spark, tmp_path):
    """Else those of all jobs of a build lie on disk until the driver collects its garbage."""
    def stored():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {name for name in disk.getAllFiles().mkString("\n").split() if "shuffle_" in name}

    before = stored()
    with session.shuffles_sized_for(spark, 0):
        counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        tables.overwrite(counts.repartitionByRange("k"), str(tmp_path / "t"))
        deadline = time.time() + 20  # files are removed a moment later
        while stored() - before and time.time() < deadline:
            time.sleep(0.1)
    assert not stored() - before and spark.read.parquet(str(tmp_path / "t")).count() == 7
    with session.short_lived_shuffles(spark):
        assert counts.collect() and sorted(counts.collect()) == sorted(counts.collect())


def test_ingest_and_the_staged_job_drop_shuffles(spark, tmp_path, monkeypatch):
    seen, before = [], spark.conf.get(SHORT_LIVED)

    def noted(*_):
        seen.append(spark.conf.get(SHORT_LIVED))
        return spark.createDataFrame([], ingest._RESULT)

    monkeypatch.setattr(ingest, "_ingest_new", noted)
    monkeypatch.setattr(pipeline, "_stages", noted)
    path = str(tmp_path / "landing")
    sample_landing.write(spark.range(3), path)
    ingest.ingest_directory(spark, path, str(tmp_path / "bronze"), str(tmp_path / "ledger"), contracts.CARDS)
    pipeline.run_pipeline(spark, str(tmp_path), run_id="one")
    assert seen == ["true", "true"] and spark.conf.get(SHORT_LIVED) == before


def test_layers_are_stored_compressed_for_size(spark, tmp_path):
    """Landing, all layers and two published versions of the staged job are on disk at once."""
    rows = spark.range(100).selectExpr("id", "CAST(id % 5 AS string) AS part")
    tables.overwrite(rows, str(tmp_path / "a"), ("part",))
    tables.append_by_partition(rows, str(tmp_path / "b"), "part")
    stored = [str(file) for file in tmp_path.rglob("*.parquet")]
    assert stored and all(".zstd." in name for name in stored)
    assert all(spark.read.parquet(str(tmp_path / name)).count() == 100 for name in "ab")
