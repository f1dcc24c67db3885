from __future__ import annotations

import os

import pytest

from cardlake.operators import ingest, publication, silver
from cardlake.plans.pipeline import Layout, run_pipeline
from cardlake.sources import ledger
from conftest import NOW, SECOND_FILE, TRANSACTION_HEADER, rows, write_csv


def last_status(spark, layout):
    return publication.read_runs(spark, layout.runs).orderBy(
        "recorded_at_utc", "status").collect()[-1]["status"]


def test_two_runs(spark, landing):
    layout = Layout(str(landing))
    first = run_pipeline(spark, str(landing), now=NOW)
    assert first["bronze"]["files_processed"] == 2 and first["bronze"]["rows_written"] == 5
    assert first["domain_bronze"]["rows_written"] == 4
    assert (first["silver"]["silver_rows_written"],
            first["silver"]["quarantine_rows_written"]) == (5, 0)
    assert (first["gold"]["merchant_rows_written"], first["gold"]["date_rows_written"],
            first["gold"]["transaction_rows_written"]) == (3, 5, 5)
    assert len(first["analytics"]["views_created"]) == 6
    published = publication.read_published(spark, layout.published)
    assert rows(published["transaction"].orderBy("transaction_key"),
                "transaction_key", "date_key", "merchant_key") == [
        (1, 20231129, 1), (2, 20231201, 3), (3, 20231201, 3), (4, 20231202, 2),
        (5, 20231203, 1)]

    second = run_pipeline(spark, str(landing), now=NOW)
    assert (second["bronze"]["files_processed"], second["bronze"]["files_skipped"],
            second["bronze"]["rows_written"]) == (0, 2, 0)
    assert second["gold"]["transaction_rows_written"] == 5
    assert second["analytics"]["platform_kpis"] == first["analytics"]["platform_kpis"]
    assert ledger.load(spark, layout.domain("transactions").ledger).count() == 2
    assert publication.current_version(spark, layout.published) == second["run_id"]
    assert last_status(spark, layout) == "SUCCESS"


def test_no_landing_files(spark, tmp_path):
    (tmp_path / "landing/transactions").mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        run_pipeline(spark, str(tmp_path), now=NOW)
    assert sorted(os.listdir(tmp_path)) == ["landing", "metadata"]
    assert last_status(spark, Layout(str(tmp_path))) == "FAILED"


def test_partial_ingest_stops_before_silver(spark, landing):
    layout = Layout(str(landing))
    write_csv(landing / "landing/transactions/b.csv", TRANSACTION_HEADER[:-1],
              [row[:-1] for row in SECOND_FILE])
    with pytest.raises(RuntimeError, match="Transaction ingest"):
        run_pipeline(spark, str(landing), now=NOW)
    paths = layout.domain("transactions")
    from cardlake import contracts

    assert ingest.read_bronze(spark, paths.bronze, contracts.TRANSACTIONS).count() == 3
    assert sorted(r["status"] for r in ledger.load(spark, paths.ledger).collect()) == [
        "FAILED", "SUCCESS"]
    assert not os.path.exists(layout.silver)
    assert not os.path.exists(layout.domain("cards").bronze)


def test_missing_users_stop_before_silver_and_keep_the_published_version(spark, landing):
    layout = Layout(str(landing))
    run_pipeline(spark, str(landing), now=NOW, run_id="good")
    (landing / "landing/users/users.csv").rename(landing / "users.away")
    before = silver.read_silver(spark, layout.silver).count()
    with pytest.raises(RuntimeError, match="Card and user ingest"):
        run_pipeline(spark, str(landing), now=NOW, run_id="bad")
    assert silver.read_silver(spark, layout.silver).count() == before
    assert publication.current_version(spark, layout.published) == "good"
    row = publication.read_runs(spark, layout.runs).where(
        "run_id = 'bad' AND status <> 'RUNNING'").first()
    assert (row["status"], row["recovery_succeeded"]) == ("FAILED", True)


def test_runs_of_lost_drivers_are_ended_by_the_next_run(spark, landing):
    layout = Layout(str(landing))
    run_pipeline(spark, str(landing), now=NOW, run_id="good")
    for run_id in ("lost", "good but unrecorded"):
        publication.record_run(
            spark, layout.runs, pipeline="card-transactions", run_id=run_id,
            status="RUNNING", started=NOW, recorded=NOW)
    # One of them had published before its driver was lost.
    version = f"{layout.published}/versions/good"
    os.rename(version, f"{layout.published}/versions/away")
    result = publication.recover_broken_runs(spark, layout.runs, layout.published, "card-transactions", NOW)
    assert result == ["good but unrecorded", "lost"]
    ends = {r["run_id"]: (r["status"], r["recovery_succeeded"]) for r in publication.read_runs(
        spark, layout.runs).where("status <> 'RUNNING'").collect()}
    assert ends["lost"] == ("RECOVERY_FAILED", False)  # the current version is gone
    os.rename(f"{layout.published}/versions/away", version)
    publication.record_run(
        spark, layout.runs, pipeline="card-transactions", run_id="another",
        status="RUNNING", started=NOW, recorded=NOW)
    again = run_pipeline(spark, str(landing), run_id="next")
    assert again["recovered_runs"] == ["another"]
    ends = {r["run_id"]: (r["status"], r["recovery_succeeded"]) for r in publication.read_runs(
        spark, layout.runs).where("status <> 'RUNNING'").collect()}
    assert ends["another"] == ("FAILED", True) and ends["next"] == ("SUCCESS", None)


def test_a_run_that_published_before_it_was_lost_is_a_success(spark, landing):
    layout = Layout(str(landing))
    run_pipeline(spark, str(landing), now=NOW, run_id="good")
    later = NOW.replace(year=NOW.year + 1)
    publication.record_run(
        spark, layout.runs, pipeline="card-transactions", run_id="good",
        status="RUNNING", started=later, recorded=later)
    assert publication.recover_broken_runs(
        spark, layout.runs, layout.published, "card-transactions", later) == ["good"]
    assert last_status(spark, layout) == "SUCCESS"
