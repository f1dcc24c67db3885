from __future__ import annotations

import hashlib

import pytest

from cardlake import contracts
from cardlake.operators import ingest
from cardlake.sources import files, landing as landing_source, ledger
from conftest import (
    CARD_HEADER, CARDS, FIRST_FILE, NOW, SECOND_FILE, TRANSACTION_HEADER, USER_HEADER, USERS,
    rows, write_csv,
)


class Area:
    """A landing directory with its bronze table and ledger."""

    def __init__(self, spark, root, contract=contracts.TRANSACTIONS):
        self.spark, self.root, self.contract = spark, root, contract
        self.landing = root / "in"
        self.bronze, self.ledger = str(root / "bronze"), str(root / "ledger")
        self.landing.mkdir()

    def put(self, name, data, header=TRANSACTION_HEADER):
        return write_csv(self.landing / name, header, data)

    def run(self, **options):
        return ingest.ingest_directory(
            self.spark, str(self.landing), self.bronze, self.ledger, self.contract,
            now=NOW, **options,
        )

    def bronze_rows(self):
        return ingest.read_bronze(self.spark, self.bronze, self.contract)

    def statuses(self):
        return sorted(
            row["status"] for row in ledger.load(self.spark, self.ledger).collect()
        )


@pytest.fixture
def area(spark, tmp_path):
    return Area(spark, tmp_path)


def outcome(result):
    return {row["source_file_name"]: row["status"] for row in result["file_results"].collect()}


def test_first_run_reads_and_second_run_skips(area):
    path = area.put("a.csv", FIRST_FILE)
    first = area.run()
    assert (first["status"], first["files_processed"], first["rows_written"]) == ("SUCCESS", 1, 3)
    second = area.run()
    assert second["status"] == "SUCCESS"
    assert (second["files_skipped"], second["rows_read"], second["rows_written"]) == (1, 0, 0)
    assert second["bronze_total_rows"] == 3
    assert area.statuses() == ["SUCCESS"]  # a skipped file leaves no ledger row

    row = area.bronze_rows().where("Day = 29").first()
    assert row["_source_file_sha256"] == hashlib.sha256(path.read_bytes()).hexdigest()
    assert row["_source_file_size_bytes"] == path.stat().st_size
    assert row["_source_file_name"] == "a.csv"
    assert row["_ingestion_timestamp_utc"].isoformat().startswith("2026-08-01T12:00")
    assert row["Merchant Name"] == -4411 and row["Zip"] == 60200.0
    assert row["Errors?"] is None


def test_later_file_is_appended_and_history_kept(area):
    area.put("a.csv", FIRST_FILE)
    area.run()
    area.put("b.csv", SECOND_FILE)
    result = area.run()
    assert (result["files_processed"], result["files_skipped"]) == (1, 1)
    assert result["bronze_total_rows"] == 5
    order = area.bronze_rows().orderBy(*contracts.LINEAGE.fieldNames())
    assert [row["Day"] for row in order.collect()] == [29, 1, 1, 2, 3]


def test_renamed_copy_is_skipped_within_and_across_runs(area):
    area.put("b copy.csv", FIRST_FILE)
    area.put("A.csv", FIRST_FILE)
    first = area.run()
    assert outcome(first) == {"A.csv": "SUCCESS", "b copy.csv": "SKIPPED"}
    area.put("c.csv", FIRST_FILE)
    second = area.run()
    assert second["files_skipped"] == 3 and second["bronze_total_rows"] == 3


def test_changed_content_under_same_name_and_size_is_read(area):
    area.put("a.csv", FIRST_FILE)
    area.run()
    changed = [[*row] for row in FIRST_FILE]
    changed[0][6] = "$9.95"
    assert len(changed[0][6]) == len(FIRST_FILE[0][6])
    area.put("a.csv", changed)
    result = area.run()
    assert result["files_processed"] == 1 and result["bronze_total_rows"] == 6


def test_both_suffix_cases_and_nothing_else_are_found(area):
    area.put("one.csv", FIRST_FILE)
    area.put("TWO.CSV", SECOND_FILE)
    area.put("note.txt", SECOND_FILE)
    area.put("nested/three.csv", SECOND_FILE)
    area.put("part=1/four.csv", SECOND_FILE)
    result = area.run()
    assert outcome(result) == {"one.csv": "SUCCESS", "TWO.CSV": "SUCCESS"}
    assert area.run()["files_skipped"] == 2


def test_names_with_blanks_and_pattern_characters(area):
    area.put("my file [1] {x}.csv", FIRST_FILE)
    area.put("a+b%20c é.csv", SECOND_FILE)
    result = area.run()
    assert (result["files_processed"], result["rows_written"]) == (2, 5)
    assert {r[0] for r in rows(area.bronze_rows(), "_source_file_name")} == {
        "my file [1] {x}.csv", "a+b%20c é.csv"}


def test_bad_file_is_isolated_recorded_and_retried(area):
    area.put("a.csv", FIRST_FILE)
    area.put("bad.csv", [row[:-1] for row in SECOND_FILE], TRANSACTION_HEADER[:-1])
    result = area.run()
    assert result["status"] == "PARTIAL_SUCCESS"
    assert (result["rows_read"], result["bronze_total_rows"]) == (3, 3)
    assert area.statuses() == ["FAILED", "SUCCESS"]
    failed = ledger.load(area.spark, area.ledger).where("status = 'FAILED'").first()
    assert failed["error_message"].startswith("ValueError: Column validation failed")
    assert "Is Fraud?" in failed["error_message"]
    area.run()
    assert area.statuses() == ["FAILED", "FAILED", "SUCCESS"]


def test_failed_files_take_no_place_in_the_order(area):
    area.put("a.csv", [row[:-1] for row in FIRST_FILE], TRANSACTION_HEADER[:-1])
    area.put("b.csv", FIRST_FILE)
    area.run()
    area.put("c.csv", SECOND_FILE)
    area.run()
    places = area.bronze_rows().select("_source_file_name", "_source_sequence").distinct()
    assert sorted(rows(places)) == [("b.csv", 0), ("c.csv", 1)]


def test_all_files_bad_fails_the_batch_and_copies_fail_too(area):
    bad = [["x", *row[1:]] for row in FIRST_FILE]
    area.put("a.csv", bad)
    area.put("b.csv", bad)
    result = area.run()
    assert result["status"] == "FAILED"
    assert outcome(result) == {"a.csv": "FAILED", "b.csv": "FAILED"}
    assert result["rows_read"] == 0
    message = result["file_results"].first()["error_message"]
    assert message.startswith("TypeError: Data-type validation failed")
    assert "'User': {'expected': 'int64', 'actual': 'str'}" in message


def test_record_with_too_many_fields_fails_its_file(area):
    area.put("a.csv", [*FIRST_FILE, [*SECOND_FILE[0], "surplus"]])
    assert area.run()["status"] == "FAILED"


def test_value_based_types_accept_what_fits(area):
    """No error text at all, whole-number postal codes and a missing user are accepted."""
    plain = [[*row] for row in FIRST_FILE]
    for row in plain:
        row[11], row[13] = row[11].removesuffix(".0"), ""
    plain[0][0] = "NA"
    area.put("a.csv", plain)
    assert area.run()["status"] == "SUCCESS"
    assert area.bronze_rows().where("User IS NULL").count() == 1


def test_strict_types_demand_the_inferred_type(area):
    plain = [[*row] for row in FIRST_FILE]
    for row in plain:
        row[11], row[13] = row[11].removesuffix(".0"), ""
    area.put("a.csv", plain)
    result = area.run(strict_types=True)
    assert result["status"] == "FAILED"
    message = result["file_results"].first()["error_message"]
    assert "'Zip': {'expected': 'float64', 'actual': 'int64'}" in message
    assert "'Errors?': {'expected': 'str', 'actual': 'float64'}" in message
    area.put("a.csv", FIRST_FILE)
    assert area.run(strict_types=True)["status"] == "SUCCESS"


def test_column_order_does_not_matter(area):
    order = list(reversed(range(len(TRANSACTION_HEADER))))
    area.put("a.csv", FIRST_FILE)
    area.put("b.csv", [[row[i] for i in order] for row in SECOND_FILE],
             [TRANSACTION_HEADER[i] for i in order])
    assert area.run()["status"] == "SUCCESS"
    assert rows(area.bronze_rows().where("Day = 3"), "User", "`Is Fraud?`") == [(12, "No")]


def test_null_words_quotes_and_blank_lines(area):
    data = [[*row] for row in FIRST_FILE]
    data[0][9], data[1][9], data[2][13] = 'Say "hi", all', "N/A", "null"
    path = area.put("a.csv", data)
    path.write_text(path.read_text() + "\n\n")
    assert area.run()["rows_read"] == 3
    cities = dict(rows(area.bronze_rows(), "`Time`", "`Merchant City`"))
    assert cities["22:05"] == 'Say "hi", all' and cities["00:00"] is None
    assert area.bronze_rows().where("`Errors?` IS NULL").count() == 2


def test_retry_after_lost_ledger_does_not_duplicate(area):
    """A crash between the bronze write and the ledger entry: the retry replaces its rows."""
    area.put("a.csv", FIRST_FILE)
    area.run()
    area.ledger = str(area.root / "new_ledger")
    result = area.run()
    assert result["files_processed"] == 1 and result["bronze_total_rows"] == 3


def test_missing_directory_file_and_empty_directory(area, tmp_path):
    with pytest.raises(FileNotFoundError):
        area.run()
    with pytest.raises(FileNotFoundError):
        landing_source.discover(area.spark, str(tmp_path / "nowhere"))
    path = area.put("a.csv", FIRST_FILE)
    with pytest.raises(NotADirectoryError):
        landing_source.discover(area.spark, str(path))


def test_single_file_checks_and_failure(area, tmp_path):
    def one(path):
        return ingest.ingest_file(
            area.spark, str(path), area.bronze, area.ledger, area.contract, now=NOW
        )

    with pytest.raises(FileNotFoundError):
        one(tmp_path / "nothing.csv")
    with pytest.raises(ValueError, match="not a file"):
        one(area.landing)
    with pytest.raises(ValueError, match="CSV"):
        one(area.put("a.txt", FIRST_FILE))
    with pytest.raises(ValueError, match="Column validation"):
        one(area.put("bad.csv", [["1"]], ["User"]))
    assert area.statuses() == ["FAILED"]
    assert one(area.put("a.csv", FIRST_FILE))["status"] == "SUCCESS"
    again = one(area.landing / "a.csv")
    assert (again["status"], again["rows_read"], again["bronze_total_rows"]) == ("SKIPPED", 0, 3)


@pytest.mark.parametrize("data", [
    b"a,b\n1,2\n", b"a,b\n1,2", b"a,b\r\n1,2\r\n\r\n", b"\n\n\n\n\n\n\n\n\n\n\n\n", b"a,b\n\xe9\xff,2\n", b"x" * 5000,
    "h\u00e9ader\r".encode() * 40,
])
def test_hash_of_pieces_equals_hash_of_the_whole(area, data):
    (area.landing / "a b%.csv").write_bytes(data)
    found = landing_source.discover(area.spark, str(area.landing))
    pieces = files.fingerprints(found, in_memory_bytes=10).first()
    assert pieces["sha256"] == hashlib.sha256(data).hexdigest()
    assert pieces == files.fingerprints(found).first()
    try:
        data.decode()
    except UnicodeDecodeError:
        assert not pieces["is_utf8"]
    else:
        assert pieces["is_utf8"]


# ------------------------------------------------------------------------- ledger


def legacy_row(spark, path, sha=None, size=100, status="SUCCESS"):
    spark.createDataFrame(
        [("old.csv", size, sha, status)],
        "source_file_name string, source_file_size_bytes bigint, "
        "source_file_sha256 string, status string",
    ).write.mode("append").parquet(path)


def known(spark, path, name, size, sha):
    file = spark.createDataFrame([(name, size, sha)], "name string, size bigint, sha256 string")
    return ledger.mark_processed(file, ledger.load(spark, path)).first()["already_processed"]


def test_legacy_rows_match_on_name_and_size(spark, tmp_path):
    path = str(tmp_path / "ledger")
    legacy_row(spark, path)
    assert known(spark, path, "old.csv", 100, "abc")
    assert not known(spark, path, "old.csv", 101, "abc")
    assert not known(spark, path, "new.csv", 100, "abc")


def test_hashed_rows_match_on_content_only(spark, tmp_path):
    path = str(tmp_path / "ledger")
    legacy_row(spark, path, sha="abc")
    assert known(spark, path, "renamed.csv", 5, "abc")
    assert not known(spark, path, "old.csv", 100, "other")


def test_failed_rows_do_not_count(spark, tmp_path):
    path = str(tmp_path / "ledger")
    legacy_row(spark, path, sha="abc", status="FAILED")
    assert not known(spark, path, "old.csv", 100, "abc")


def test_old_ledger_gets_all_columns_and_accepts_new_rows(spark, tmp_path):
    path = str(tmp_path / "ledger")
    legacy_row(spark, path)
    assert ledger.load(spark, path).schema == ledger.SCHEMA
    ledger.append(spark, path, spark.createDataFrame([("x.csv", "FAILED")],
                                                     "source_file_name string, status string"))
    loaded = ledger.load(spark, path)
    assert loaded.columns == ledger.SCHEMA.fieldNames() and loaded.count() == 2


def test_absent_ledger_is_empty(spark, tmp_path):
    empty = ledger.load(spark, str(tmp_path / "none"))
    assert empty.columns == ledger.SCHEMA.fieldNames() and empty.count() == 0


# ------------------------------------------------------------------------ domains


def domain_paths(root, name):
    return ingest.DomainPaths(
        str(root / "landing" / name), str(root / "bronze" / name), str(root / "ledger" / name)
    )


def test_card_domain_twice(spark, tmp_path):
    write_csv(tmp_path / "landing/cards/c.csv", CARD_HEADER, CARDS)
    paths = domain_paths(tmp_path, "cards")
    first = ingest.ingest_domain(spark, " Cards ", paths, now=NOW)
    assert (first["source_domain"], first["files_processed"], first["rows_written"]) == (
        "cards", 1, 2)
    second = ingest.ingest_domain(spark, "cards", paths, now=NOW)
    assert (second["files_skipped"], second["rows_written"]) == (1, 0)
    assert ledger.load(spark, paths.ledger).count() == 1


def test_unknown_domain_is_rejected(spark, tmp_path):
    with pytest.raises(ValueError, match=r"loans.*\['cards', 'transactions', 'users'\]"):
        ingest.ingest_domain(spark, "loans", domain_paths(tmp_path, "loans"))


def test_two_domains(spark, tmp_path):
    write_csv(tmp_path / "landing/cards/c.csv", CARD_HEADER, CARDS)
    write_csv(tmp_path / "landing/users/u.csv", USER_HEADER, USERS)
    result = ingest.ingest_domains(
        spark, {name: domain_paths(tmp_path, name) for name in ("cards", "users")}, now=NOW
    )
    assert (result["status"], result["domains_succeeded"], result["rows_written"]) == (
        "SUCCESS", 2, 4)


def test_missing_domain_leaves_the_other_running(spark, tmp_path):
    write_csv(tmp_path / "landing/cards/c.csv", CARD_HEADER, CARDS)
    result = ingest.ingest_domains(
        spark, {name: domain_paths(tmp_path, name) for name in ("cards", "users")}, now=NOW
    )
    assert result["status"] == "PARTIAL_SUCCESS"
    assert (result["domains_failed"], result["files_failed"], result["rows_written"]) == (1, 1, 2)
    assert result["domain_results"]["users"]["error_message"].startswith("FileNotFoundError")


# ------------------------------------------------------- files that must not pass or stop others


def line(**changes):
    values = dict(zip(TRANSACTION_HEADER, FIRST_FILE[0])) | changes
    return ",".join(values.values())


HEAD = ",".join(TRANSACTION_HEADER)


@pytest.mark.parametrize("name, data, error", [
    ("surplus.csv", f"{HEAD}\n{line()},,junk\n", "more than 15 fields"),
    ("empty_surplus.csv", f"{HEAD}\n{line()},\n", "more than 15 fields"),
    ("open_quote.csv", HEAD + "\n" + line(**{"Merchant City": '"Brno'}) + "\n", "quote that is not closed"),
    ("only_header.csv", HEAD + "\n", "Data-type validation"),
    ("nothing.csv", "", "Column validation"),
    ("_hidden.csv", f"{HEAD}\n{line()}\n", "cannot be scanned"),
    (".hidden.CSV", f"{HEAD}\n{line()}\n", "cannot be scanned"),
    ("long_header.csv", "x" * 3_000_000 + "\n1\n", "Column validation"),
    ("latin.csv", (HEAD + "\n" + line(**{"Merchant City": "Montr\u00e9al"}) + "\n").encode("latin-1"), "UTF-8"),
])
def test_a_broken_file_fails_alone(area, name, data, error):
    (area.landing / name).write_bytes(data if isinstance(data, bytes) else data.encode())
    area.put("good.csv", FIRST_FILE)
    result = area.run()
    assert outcome(result) == {"good.csv": "SUCCESS", name: "FAILED"}
    assert (result["status"], result["rows_written"]) == ("PARTIAL_SUCCESS", 3)
    failed = ledger.load(area.spark, area.ledger).where("status = 'FAILED'").collect()
    assert len(failed) == 1 and error in failed[0]["error_message"]


def test_bare_carriage_returns_end_lines(area):
    (area.landing / "old.csv").write_bytes("\r".join([HEAD, line(), line(Day="30")]).encode() + b"\r")
    assert area.run()["rows_written"] == 2


def test_short_records_quoted_commas_and_literal_quotes_pass(area):
    rows_ = [line(**{"Merchant City": '"Brno, ""old"" town"'}), line(**{"Merchant City": 'the 5" shop'}), "11,3,2023,11,29"]
    (area.landing / "a.csv").write_text("\n".join([HEAD, *rows_]) + "\n")
    assert area.run()["rows_written"] == 3
    assert area.bronze_rows().where("`Merchant City` = 'Brno, \"old\" town'").count() == 1


def test_a_job_that_fails_is_repeated_without_the_file_at_fault(area, monkeypatch):
    for name in ("a.csv", "b.csv", "c.csv", "d.csv"):
        area.put(name, [[*FIRST_FILE[0][:-2], name, "No"]])
    scan = landing_source.scan

    def fragile(spark, paths, *rest):
        if any(path.endswith("b.csv") for path in paths):
            raise OSError("lost block")
        return scan(spark, paths, *rest)

    monkeypatch.setattr(landing_source, "scan", fragile)
    result = area.run()
    assert outcome(result) == {"a.csv": "SUCCESS", "b.csv": "FAILED", "c.csv": "SUCCESS", "d.csv": "SUCCESS"}
    monkeypatch.undo()
    assert outcome(area.run())["b.csv"] == "SUCCESS"
    assert area.bronze_rows().count() == 4


# ------------------------------------------------------------ faults outside the files, crashes


def test_a_full_disk_fails_the_run_and_no_file(area, monkeypatch):
    for name in ("a.csv", "b.csv", "c.csv", "d.csv"):
        area.put(name, [[*FIRST_FILE[0][:-2], name, "No"]])
    tries = []

    def full(*arguments):
        tries.append(arguments)
        raise OSError("No space left on device")

    monkeypatch.setattr(ingest.tables, "append_by_partition", full)
    with pytest.raises(ingest.IngestAborted, match="No space left"):
        area.run()
    assert len(tries) == ingest.ATTEMPTS  # the whole batch, not its halves
    assert ledger.load(area.spark, area.ledger).isEmpty()
    monkeypatch.undo()
    assert set(outcome(area.run()).values()) == {"SUCCESS"}
    assert area.bronze_rows().count() == 4


def test_a_target_that_cannot_be_written_fails_the_run_and_no_file(area):
    area.put("a.csv", FIRST_FILE)
    area.put("b.csv", SECOND_FILE)
    with open(area.bronze, "w") as blocking:
        blocking.write("a file where the table should be")
    with pytest.raises(ingest.IngestAborted):
        area.run()
    assert ledger.load(area.spark, area.ledger).isEmpty()


def test_a_passing_fault_is_tried_again(area, monkeypatch):
    area.put("a.csv", FIRST_FILE)
    append, tries = ingest.tables.append_by_partition, []

    def flaky(*arguments):
        tries.append(1)
        if len(tries) < ingest.ATTEMPTS:
            raise OSError("Connection reset by peer")
        append(*arguments)

    monkeypatch.setattr(ingest.tables, "append_by_partition", flaky)
    assert outcome(area.run()) == {"a.csv": "SUCCESS"} and len(tries) == ingest.ATTEMPTS


def test_a_lost_store_is_no_fault_of_many_files(area, monkeypatch):
    for i in range(40):
        area.put(f"f{i:02d}.csv", [[*FIRST_FILE[0][:-2], str(i), "No"]])
    tries = []

    def lost(spark, paths, *rest):
        tries.append(len(paths))
        raise OSError("input/output error")

    monkeypatch.setattr(landing_source, "scan", lost)
    with pytest.raises(ingest.IngestAborted, match="8 files in a row"):
        area.run()
    assert len(tries) < 30 and ledger.load(area.spark, area.ledger).isEmpty()
    monkeypatch.undo()
    assert area.run()["files_processed"] == 40


@pytest.mark.parametrize("text, writing, of_a_file", [
    ("[FAILED_READ_FILE.NO_HINT] Encountered error while reading file x.csv", True, True),
    ("[TASK_WRITE_FAILED] ... Caused by: [FAILED_READ_FILE.FILE_NOT_EXIST] x.csv", True, True),
    ("[TASK_WRITE_FAILED] Task failed while writing rows", True, False),
    ("something odd", False, True), ("java.lang.OutOfMemoryError: Java heap space", False, False),
    ("ExecutorLostFailure (executor 3 exited)", False, False),
])
def test_faults_are_told_apart(text, writing, of_a_file):
    assert ingest.is_of_a_file(RuntimeError(text), writing) == of_a_file


def sequences(area):
    return {r[0]: r[1] for r in area.bronze_rows().select("_source_file_name", "_source_sequence").distinct().collect()}


def test_a_crash_before_the_ledger_entry_leaves_no_number_twice(area, monkeypatch):
    area.put("a.csv", FIRST_FILE)
    assert area.run()["files_processed"] == 1
    area.put("b.csv", SECOND_FILE)

    def crash(*arguments):
        raise KeyboardInterrupt

    monkeypatch.setattr(ingest.ledger, "append", crash)
    with pytest.raises(KeyboardInterrupt):
        area.run()
    assert sequences(area) == {"a.csv": 0, "b.csv": 1}  # written, and not in the ledger
    monkeypatch.undo()
    (area.landing / "b.csv").rename(area.landing / "b.away")
    area.put("c.csv", [[*FIRST_FILE[0][:-2], "later", "No"]])
    assert area.run()["files_processed"] == 1
    assert sequences(area) == {"a.csv": 0, "c.csv": 2}  # the rows of the lost batch are withdrawn
    (area.landing / "b.away").rename(area.landing / "b.csv")
    assert area.run()["files_processed"] == 1
    assert sequences(area) == {"a.csv": 0, "b.csv": 1, "c.csv": 2}  # content keeps its number
    assert area.run()["bronze_total_rows"] == 6


def test_finished_rows_stay_when_the_ledger_is_lost(area):
    import shutil

    area.put("a.csv", FIRST_FILE)
    area.run()
    shutil.move(area.ledger, area.ledger + ".away")
    (area.landing / "a.csv").rename(area.landing / "a.away")
    area.put("b.csv", SECOND_FILE)
    area.run()
    assert sequences(area) == {"a.csv": 0, "b.csv": 1}


def test_a_new_batch_numbers_on_after_a_ledger_without_numbers(area):
    import shutil

    area.put("a.csv", FIRST_FILE)
    area.run()
    shutil.move(area.ledger + "_numbers", area.ledger + "_numbers.away")
    area.put("b.csv", SECOND_FILE)
    area.run()
    assert sequences(area) == {"a.csv": 0, "b.csv": 1}
