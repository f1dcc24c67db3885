"""Incremental, idempotent ingest of landing CSV files into bronze."""

from __future__ import annotations

import json
import re
import uuid
from collections import defaultdict
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cardlake import contracts
from cardlake.session import short_lived_shuffles, small_scans, stage, staged_tables, staging_path
from cardlake.sources import files, landing, ledger, tables

# Files handled by one Spark job. It bounds the file table that is broadcast to the
# scan tasks; further files simply go into further jobs.
FILES_PER_JOB = 10_000

PARTITION = "_source_file_sha256"

# A job that fails for a reason outside its files is tried so many times in all.
ATTEMPTS = 3
# So many files in a row that cannot be read, right after all of them were hashed, mean that
# the store is gone and not that the files are bad.
SUSPECT_FILES = 8

# Words in the errors of jobs (fixed values): what tells that reading a file failed, and what
# tells that disk, memory, network or executors did.
_READING = re.compile(
    r"FAILED_READ_FILE|FILE_NOT_EXIST|MALFORMED_|TextParsingException|CANNOT_PARSE|UNTERMINATED")
_OUTSIDE = re.compile(
    r"TASK_WRITE_FAILED|No space left|Disk quota|OutOfMemoryError|ExecutorLost|Lost executor|ConnectException|Connection refused|"
    r"Connection reset|SocketTimeout|UnknownHost|Read-only file system|SparkContext was shut down|Py4JNetworkError|"
    r"FetchFailed|MetadataFetchFailed|safe mode")


class IngestAborted(RuntimeError):
    """Disk, network or cluster failed: no file is to blame, and none is recorded as failed."""

_RESULT = T.StructType([
    T.StructField("source_file_name", T.StringType()),
    T.StructField("source_file_size_bytes", T.LongType()),
    T.StructField("source_file_sha256", T.StringType()),
    T.StructField("pipeline_run_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("rows_written", T.LongType()),
    T.StructField("error_message", T.StringType()),
])


@dataclass
class _File:
    """A file of one job: its listing entry and what became of it."""

    path: str
    name: str
    scan_name: str
    size: int
    sha256: str
    run_id: str
    rows: int = 0
    error: str | None = None
    sequence: int = 0
    copy: str | None = None


_LISTED = ("path", "name", "scan_name", "size", "sha256", "run_id")
_OUTCOME = "path string, rows bigint, error string, copy string"


def bronze_schema(contract: T.StructType) -> T.StructType:
    return T.StructType([*contract, *contracts.AUDIT, *contracts.LINEAGE])


def read_bronze(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """Bronze rows in contract order; an empty table before the first ingest."""
    schema = bronze_schema(contract)
    if not tables.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(
        *[f"`{name}`" for name in schema.fieldNames()]
    )


def ingest_directory(
    spark: SparkSession, landing_path: str, bronze_path: str, ledger_path: str,
    contract: T.StructType, *, strict_types: bool = False, multiline: bool = False,
    now: datetime | None = None,
) -> dict:
    """Bring every new CSV file of a directory into bronze.

    Files are told apart by content. A file that breaks the contract is recorded as
    failed and does not stop the others; it is tried again next time.
    """
    found = landing.discover(spark, landing_path)
    return _ingest(
        spark, landing_path, found, bronze_path, ledger_path, contract,
        strict_types, multiline, now,
    )


def ingest_file(
    spark: SparkSession, source_file: str, bronze_path: str, ledger_path: str,
    contract: T.StructType, *, strict_types: bool = False, multiline: bool = False,
    now: datetime | None = None,
) -> dict:
    """Bring one file into bronze; a failure is recorded and then raised."""
    found = landing.single_file(spark, source_file)
    batch = _ingest(
        spark, source_file, found, bronze_path, ledger_path, contract,
        strict_types, multiline, now,
    )
    result = batch["file_results"].first().asDict()
    if result["status"] == ledger.FAILED:
        kind, _, message = result["error_message"].partition(": ")
        raise {"TypeError": TypeError}.get(kind, ValueError)(message)
    return {**result, "bronze_total_rows": batch["bronze_total_rows"]}


def _ingest(
    spark, source, found, bronze_path, ledger_path, contract, strict_types, multiline, now
) -> dict:
    withdraw_unfinished(spark, bronze_path, ledger_path)
    # Staged are listings and copies of records; the results outlive them.
    with staged_tables(spark), small_scans(spark), short_lived_shuffles(spark):
        results = _ingest_new(
            spark, found, bronze_path, ledger_path, contract, strict_types, multiline,
            now or datetime.now(timezone.utc),
        )
    return _roll_up(spark, source, results, bronze_path, contract)


def _ingest_new(
    spark, found, bronze_path, ledger_path, contract, strict_types, multiline, now
) -> DataFrame:
    history = ledger.load(spark, ledger_path)
    # Stored: the leaders are found by joining the listing with itself, which would hash twice.
    listed = stage(_fingerprinted(spark, found), "fingerprints")
    marked = stage(
        _mark_leaders(ledger.mark_processed(listed, history))
        .withColumn("_header", landing.layouts(F.col("header"), contract))
        .select(
            "*", F.col("_header.layout").alias("layout"), F.expr("uuid()").alias("run_id"),
            F.when(F.col("sha256").isNull(), F.coalesce("problem", F.lit("OSError: The file cannot be read")))
            .when(~F.col("is_utf8"), "ValueError: The file is not valid UTF-8")
            .otherwise(F.col("_header.error")).alias("error"),
        ).drop("_header", "header", "problem", "is_utf8"),
        "landing",
    )
    jobs = _jobs(marked)
    outcomes = staging_path(spark, "outcomes")
    spark.createDataFrame([], _OUTCOME).write.parquet(outcomes)
    for layout, of_job in jobs:
        batch = _collect(of_job)
        _check_values(spark, batch, layout, contract, strict_types, multiline)
        _record(spark, batch, outcomes)
    checked = spark.read.schema(_OUTCOME).parquet(outcomes)
    accepted = marked.join(checked.where("error IS NULL").select("path"), "path", "left_semi").select(
        "path", "name", F.col("sha256").alias("source_file_sha256"))
    batch_id = uuid.uuid4().hex
    ledger.reserve(spark, ledger_path, batch_id, accepted)
    taken = ledger.numbers(spark, ledger_path).groupBy("source_file_sha256").agg(F.min("sequence").alias("sequence"))
    numbered = stage(
        accepted.join(taken, "source_file_sha256").join(checked.select("path", "copy"), "path")
        .select("path", "sequence", "copy"), "numbers")
    written = staging_path(spark, "outcomes")
    spark.createDataFrame([], _OUTCOME).write.parquet(written)
    for layout, of_job in jobs:
        batch = _collect(of_job.join(numbered, "path"), "sequence", "copy")
        _write(spark, batch, contract, bronze_path, now)
        _record(spark, [f for f in batch if f.error is not None], written)
    failed_late = spark.read.schema(_OUTCOME).parquet(written).select("path", F.col("error").alias("late_error"))

    results = _results(marked, checked.join(failed_late, "path", "left").select(
        "path", "rows", F.coalesce("error", "late_error").alias("value_error")))
    ledger.append(
        spark, ledger_path,
        results.where(F.col("status") != ledger.SKIPPED)
        .withColumn("processed_at_utc", F.lit(now).cast("timestamp")),
    )
    ledger.finish(spark, ledger_path, batch_id)
    return results


def withdraw_unfinished(spark: SparkSession, bronze_path: str, ledger_path: str) -> None:
    """Remove bronze rows of batches that broke off before their ledger entry.

    Their files are read again if they are still there. Done before a batch starts, so a
    bronze table holds what its ledger lists.
    """
    for row in ledger.unfinished(spark, ledger_path).toLocalIterator():
        tables.drop_partition(spark, bronze_path, f"{PARTITION}={row['source_file_sha256']}")


def _fingerprinted(spark: SparkSession, found: files.Files) -> DataFrame:
    """Hashed listing, with a row without a hash for each file that scans leave out."""
    listed = files.fingerprints(found).drop("scan_path").withColumn("problem", F.lit(None).cast("string"))
    unscanned = landing.unscanned_files(spark, found)
    if not unscanned:
        return listed
    rows = spark.createDataFrame(unscanned, "path string, name string, size bigint, problem string")
    return listed.join(rows.select("path"), "path", "left_anti").unionByName(rows, allowMissingColumns=True)


def _jobs(marked: DataFrame) -> list[tuple[tuple, DataFrame]]:
    """New files with a good header by column order, in jobs of about ``FILES_PER_JOB``.

    Only layouts and their counts come to the driver here.
    """
    good = marked.where(F.col("leader") & F.col("error").isNull())
    jobs = []
    for row in good.groupBy("layout").agg(F.count("*").alias("n")).orderBy("layout").collect():
        parts = -(-row["n"] // FILES_PER_JOB)
        own = good.where(F.col("layout") == row["layout"])
        job = F.pmod(F.xxhash64("path"), F.lit(parts))
        jobs += [(tuple(json.loads(row["layout"])), own.where(job == k)) for k in range(parts)]
    return jobs


def _collect(of_job: DataFrame, *more: str) -> list[_File]:
    return [_File(**row.asDict()) for row in of_job.select(*_LISTED, *more).orderBy("path").collect()]


def _record(spark: SparkSession, batch: list[_File], path: str) -> None:
    spark.createDataFrame(
        [(f.path, f.rows, f.error, f.copy) for f in batch], _OUTCOME
    ).coalesce(1).write.mode("append").parquet(path)


def is_of_a_file(problem: Exception, writing: bool) -> bool:
    """Whether a file can be to blame for an error of a job.

    A failure to read names the file, also inside a job that writes. Failed write tasks and
    words that tell of disk, memory, network or executors are nobody's; so is all else that
    breaks a job that writes to a table (``writing``), and the file's otherwise.
    """
    text = f"{type(problem).__name__}: {problem}"
    if _READING.search(text):
        return True
    return not writing and not _OUTSIDE.search(text)


class _Isolation:
    """Runs a job over files; when a file breaks it, over halves, until that file is alone.

    The file gets the error; all others are worked through. A job that breaks for another
    reason is repeated as it is, and in the end aborts the batch.
    """

    def __init__(self, job, writing: bool) -> None:
        self.job, self.writing, self.in_a_row = job, writing, 0

    def run(self, batch: list[_File]) -> None:
        if not batch:
            return
        for attempt in range(1, ATTEMPTS + 1):
            try:
                self.job(batch)
            except Exception as error:  # sorted by whose fault it is
                if is_of_a_file(error, self.writing):
                    problem = error
                    break
                if attempt == ATTEMPTS:
                    raise IngestAborted(f"The job failed {ATTEMPTS} times: {_first_line(error)}") from error
            else:
                self.in_a_row = 0
                return
        if len(batch) > 1:
            middle = len(batch) // 2
            self.run(batch[:middle])
            self.run(batch[middle:])
            return
        self.in_a_row += 1
        if self.in_a_row >= SUSPECT_FILES:
            raise IngestAborted(
                f"{self.in_a_row} files in a row cannot be read any more: {_first_line(problem)}") from problem
        batch[0].error = _first_line(problem)


def _first_line(problem: Exception) -> str:
    lines = str(problem).strip().splitlines() or [""]
    return f"{type(problem).__name__}: {lines[0]}"[:4000]


def _mark_leaders(listed: DataFrame) -> DataFrame:
    """Of new files with equal content only the first by name is read."""
    new = ~F.col("already_processed")
    leaders = listed.where(new).groupBy("sha256").agg(
        F.min_by("path", F.struct(F.lower("name"), F.col("name"))).alias("_leader")
    )
    return (
        listed.join(leaders, "sha256", "left")
        .withColumn("leader", new & F.coalesce(F.col("path") == F.col("_leader"), F.col("sha256").isNull()))
        .drop("_leader")
    )


def _check_values(spark, batch, layout, contract, strict_types, multiline) -> None:
    """Copy the records of a job's files and check the values; one row per file comes back.

    The copy holds every field as text. It is what is checked and what bronze is written
    from, so landing bytes are read twice in all: hashed and copied.
    """
    judge = landing.observed_types if strict_types else landing.acceptable_types
    empty = defaultdict(int)

    def check(part: list[_File]) -> None:
        copy = staging_path(spark, "landing-copy")
        scanned = landing.scan(spark, [file.path for file in part], layout, multiline)
        scanned.write.option("compression", tables.COMPRESSION).parquet(copy)
        profiles = {
            row["_file"]: row.asDict()
            for row in landing.value_profile(spark.read.parquet(copy), contract).collect()
        }
        for file in part:
            file.copy = copy
            profile = profiles.get(file.scan_name, empty)
            file.rows = profile["rows"]
            types = contracts.check_types(
                judge(profile, contract), contracts.expected_types(contract)
            )
            if profile["overlong"]:
                file.error = (
                    f"ValueError: {profile['overlong']} records have more than "
                    f"{len(contract)} fields"
                )
            elif profile["unclosed"]:
                file.error = f"ValueError: {profile['unclosed']} records have a quote that is not closed"
            elif not types["is_valid"]:
                file.error = f"TypeError: Data-type validation failed: {types}"

    _Isolation(check, writing=False).run(batch)


def _write(spark, batch, contract, bronze_path, now) -> None:
    """Write checked files from their copies to their own bronze partitions.

    The joined table has one row per file of this job (about ``FILES_PER_JOB``).
    """
    def write(part: list[_File]) -> None:
        audit = spark.createDataFrame(
            [(f.scan_name, f.name, f.size, f.sha256, f.run_id, f.sequence) for f in part],
            "_scan_name string, _source_file_name string, _source_file_size_bytes bigint, "
            "_source_file_sha256 string, _pipeline_run_id string, _source_sequence bigint",
        )
        copied = spark.read.parquet(*sorted({f.copy for f in part}))
        rows = copied.join(
            F.broadcast(audit), F.col("_file") == F.col("_scan_name")
        ).select(
            *landing.typed(copied, contract),
            "_source_file_name", "_source_file_size_bytes", "_source_file_sha256",
            F.lit(now).cast("timestamp").alias("_ingestion_timestamp_utc"),
            "_pipeline_run_id", "_source_sequence",
            F.col("_block_start").alias("_source_block_start"),
            F.col("_row").alias("_source_row"),
        )
        tables.append_by_partition(rows, bronze_path, PARTITION)

    _Isolation(write, writing=True).run(batch)


def _results(marked: DataFrame, checked: DataFrame) -> DataFrame:
    """One row per listed file. Copies of a read file share its fate: skipped when it
    was good, failed when it was not."""
    own = marked.join(checked, "path", "left").withColumn("error", F.coalesce("error", "value_error"))
    read_once = own.where(F.col("leader") & F.col("sha256").isNotNull()).select(
        "sha256", F.col("run_id").alias("read_by"), F.col("rows").alias("read_rows"),
        F.col("error").alias("read_error"))
    joined = own.join(read_once, "sha256", "left")
    new = ~F.col("already_processed")
    error = F.when(new, F.coalesce("read_error", F.when(F.col("sha256").isNull(), F.col("error"))))
    failed = error.isNotNull()
    read = F.col("leader") & ~failed
    status = (
        F.when(failed, ledger.FAILED).when(read, ledger.SUCCESS).otherwise(ledger.SKIPPED)
    )
    rows = F.coalesce("read_rows", F.lit(0))
    joined = joined.select(
        F.col("name").alias("source_file_name"),
        F.col("size").alias("source_file_size_bytes"),
        F.col("sha256").alias("source_file_sha256"),
        F.when(failed | read, F.coalesce("read_by", "run_id")).alias("pipeline_run_id"),
        status.alias("status"),
        F.when(failed | read, rows).otherwise(0).cast("bigint").alias("rows_read"),
        F.when(read, rows).otherwise(0).cast("bigint").alias("rows_written"),
        error.alias("error_message"),
    )
    return stage(joined.select(*_RESULT.fieldNames()), "ingest-results", keep=True)


def _roll_up(spark, source, results, bronze_path, contract) -> dict:
    """Batch totals. Rows of failed files do not count as read."""
    def count(status: str):
        return F.count(F.when(F.col("status") == status, True))

    def rows(name: str):
        good = F.when(F.col("status") != ledger.FAILED, F.col(name))
        return F.coalesce(F.sum(good), F.lit(0))

    totals = results.agg(
        F.count(F.lit(1)).alias("files_discovered"),
        count(ledger.SUCCESS).alias("files_processed"),
        count(ledger.SKIPPED).alias("files_skipped"),
        count(ledger.FAILED).alias("files_failed"),
        rows("rows_read").alias("rows_read"),
        rows("rows_written").alias("rows_written"),
    ).first().asDict()
    return {
        "status": batch_status(totals),
        "landing_path": source,
        **totals,
        "bronze_total_rows": read_bronze(spark, bronze_path, contract).count(),
        "bronze_output_path": bronze_path,
        "file_results": results.orderBy(F.lower("source_file_name"), "source_file_name"),
    }


def batch_status(totals: Mapping[str, int]) -> str:
    if not totals["files_failed"]:
        return "SUCCESS"
    moved = totals["files_processed"] + totals["files_skipped"]
    return "PARTIAL_SUCCESS" if moved else "FAILED"


# ------------------------------------------------------------------------- domains


@dataclass(frozen=True)
class DomainPaths:
    landing: str
    bronze: str
    ledger: str


def ingest_domain(spark: SparkSession, domain: str, paths: DomainPaths, **options) -> dict:
    """Ingest one registered source domain."""
    name, contract = contracts.contract_for(domain)
    result = ingest_directory(
        spark, paths.landing, paths.bronze, paths.ledger, contract, **options
    )
    return {"source_domain": name, **result}


_TOTALS = ("files_discovered", "files_processed", "files_skipped", "files_failed",
           "rows_read", "rows_written")


def ingest_domains(
    spark: SparkSession, domains: Mapping[str, DomainPaths], **options
) -> dict:
    """Ingest several domains; one that fails does not keep the others from running."""
    results = {}
    for name, paths in domains.items():
        try:
            results[name] = ingest_domain(spark, name, paths, **options)
        except Exception as error:  # recorded per domain, as a failed file is per batch
            results[name] = {
                "source_domain": name, "status": "FAILED",
                "landing_path": paths.landing, "bronze_output_path": paths.bronze,
                **dict.fromkeys(_TOTALS, 0), "files_failed": int(not isinstance(error, IngestAborted)),
                "bronze_total_rows": 0,
                "error_message": f"{type(error).__name__}: {error}",
            }
    statuses = [result["status"] for result in results.values()]
    succeeded = statuses.count("SUCCESS")
    if succeeded == len(statuses):
        status = "SUCCESS"
    elif succeeded or "PARTIAL_SUCCESS" in statuses:
        status = "PARTIAL_SUCCESS"
    else:
        status = "FAILED"
    return {
        "status": status,
        "domains_discovered": len(results),
        "domains_succeeded": succeeded,
        "domains_failed": len(results) - succeeded,
        **{name: sum(result[name] for result in results.values()) for name in _TOTALS},
        "domain_results": results,
    }
