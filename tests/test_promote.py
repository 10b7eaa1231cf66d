from __future__ import annotations

import json
import time
from datetime import UTC, datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from shapes import CURRENT, SAMPLE, SAMPLE_DAILY, SAMPLE_NET, csv_line, write_csv
from tallygate.contract import DAILY_SALES, LOAD_AUDIT, MART
from tallygate.operators.quality import QualityError
from tallygate.operators.reports import mart_integrity
from tallygate.plans import promote as promote_plan
from tallygate.plans import lease as lease_plan
from tallygate.plans.lake import reconcile_run
from tallygate.plans.lease import LeaseHeldError, LeaseLostError
from tallygate.plans.promote import (
    MartLoadError,
    audit_entry,
    begin_load,
    current_mart,
    incoming_rows,
    load_audit,
    mart_after_load,
    misfits,
    observed_stage,
    promote_run,
    remove_old_loads,
    resume_run,
    show_mart,
    surviving_rows,
)
from tallygate.plans.publish import publish_snapshot
from tallygate.sources import files
from tallygate.sources.runs import MarkerError, read_listed_daily_sales, read_manifest

NOW = datetime(2026, 2, 3, 4, 5, 6, tzinfo=UTC)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Three published runs: the sample, a single line, and one without sales."""
    base = tmp_path_factory.mktemp("lake")
    snapshots = {
        "sample": SAMPLE,
        "small": [csv_line()],
        "none": [csv_line(status="cancelled")],
    }
    for run_id, lines in snapshots.items():
        raw = write_csv(base / "raw" / run_id, "a.csv", lines)
        publish_snapshot(spark, raw, str(base), run_id, "2026-01-20", 0.4)
    return str(base)


def mart_rows(spark, mart):
    return {
        tuple(str(v) if n in (0, 6, 7, 8) else v for n, v in enumerate(row[:9]))
        for row in current_mart(spark, mart).collect()
    }


def audited(spark, mart):
    return [(row.run_id, row.row_count) for row in load_audit(spark, mart).collect()]


def test_a_mart_is_empty_before_its_first_load(spark, tmp_path):
    assert current_mart(spark, str(tmp_path)).schema == MART
    assert current_mart(spark, str(tmp_path)).count() == 0
    assert load_audit(spark, str(tmp_path)).schema == LOAD_AUDIT


def test_a_load_replaces_the_mart_and_a_replay_does_nothing(spark, lake, tmp_path):
    mart = str(tmp_path / "mart")
    first = promote_run(spark, lake, mart, "small")
    assert first["loaded"] and first["row_count"] == 1
    assert promote_run(spark, lake, mart, "sample")["loaded"]
    assert mart_rows(spark, mart) == SAMPLE_DAILY
    again = promote_run(spark, lake, mart, "small")
    assert again == {**first, "loaded": False}
    assert mart_rows(spark, mart) == SAMPLE_DAILY
    assert audited(spark, mart) == [("sample", len(SAMPLE_DAILY)), ("small", 1)]
    integrity = mart_integrity(current_mart(spark, mart)).first()
    assert (integrity.snapshot_count, integrity.inconsistent_rows) == (1, 0)
    origins = current_mart(spark, mart).select("source_run_id", "loaded_at").distinct().collect()
    newest = load_audit(spark, mart).first()
    assert [tuple(row) for row in origins] == [("sample", newest.loaded_at)]


def test_a_run_without_sales_empties_the_mart(spark, lake, tmp_path):
    mart = str(tmp_path)
    promote_run(spark, lake, mart, "sample")
    assert promote_run(spark, lake, mart, "none")["row_count"] == 0
    assert mart_rows(spark, mart) == set()
    assert audited(spark, mart) == [("none", 0), ("sample", len(SAMPLE_DAILY))]


def test_the_loser_of_a_race_tries_the_next_number(spark, lake, tmp_path, monkeypatch):
    mart, real = str(tmp_path), files.write_once
    rivals = ["small"]

    def overtaken(session, path, record):
        if "load_audit" in path and record["run_id"] == "sample" and rivals:
            promote_run(spark, lake, mart, rivals.pop())
        real(session, path, record)

    monkeypatch.setattr(promote_plan.files, "write_once", overtaken)
    assert promote_run(spark, lake, mart, "sample", seconds=0)["loaded"]
    assert audited(spark, mart) == [("sample", len(SAMPLE_DAILY)), ("small", 1)]
    assert mart_rows(spark, mart) == SAMPLE_DAILY


def test_the_same_run_is_loaded_by_one_of_two_racers(spark, lake, tmp_path, monkeypatch):
    mart, real = str(tmp_path), files.write_once
    rivals = ["sample"]

    def overtaken(session, path, record):
        if "load_audit" in path and rivals:
            promote_run(spark, lake, mart, rivals.pop())
        real(session, path, record)

    monkeypatch.setattr(promote_plan.files, "write_once", overtaken)
    assert not promote_run(spark, lake, mart, "sample", seconds=0)["loaded"]
    assert audited(spark, mart) == [("sample", len(SAMPLE_DAILY))]
    assert len(list((tmp_path / "daily_sales").iterdir())) == 1


def test_a_held_lease_makes_others_wait_and_a_crashed_one_ends(spark, lake, tmp_path):
    mart = str(tmp_path)
    first = begin_load(spark, lake, mart, "small", seconds=3600)
    with pytest.raises(LeaseHeldError):
        begin_load(spark, lake, mart, "sample", patience=0.2)
    assert first.commit()["loaded"]  # which releases it
    crashed = begin_load(spark, lake, mart, "sample", seconds=0.3)
    again = begin_load(spark, lake, mart, "sample", patience=30)
    assert again.lease.number > crashed.lease.number and again.commit()["loaded"]
    with pytest.raises(LeaseLostError):
        crashed.commit()
    assert audited(spark, mart) == [("sample", len(SAMPLE_DAILY)), ("small", 1)]
    assert remove_old_loads(spark, mart, keep=2) == [crashed.location.rsplit("/", 1)[1]]


def test_readers_ignore_what_a_late_writer_commits(spark, lake, tmp_path):
    mart = str(tmp_path)
    late = begin_load(spark, lake, mart, "small", seconds=0)
    promote_run(spark, lake, mart, "sample")
    promote_run(spark, lake, mart, "none")
    files.write_once(spark, late.path, late.record(0))  # it never looked again
    assert mart_rows(spark, mart) == set()
    assert audited(spark, mart) == [("none", 0), ("sample", len(SAMPLE_DAILY))]
    assert promote_run(spark, lake, mart, "small")["loaded"]  # it was never loaded
    assert audited(spark, mart) == [("small", 1), ("none", 0), ("sample", len(SAMPLE_DAILY))]


def test_of_two_claims_of_a_number_the_earliest_holds_it(spark, tmp_path):
    place = str(tmp_path / "lease")
    seen = []
    real = files.write_once

    def both(session, path, record):
        real(session, path, record)
        if not seen:
            seen.append(path)
            time.sleep(0.05)
            real(session, path.rsplit("-", 1)[0] + "-0000.json", {**record, "owner": "0000", "until": 0})

    lease_plan.files.write_once, kept = both, lease_plan.files.write_once
    try:
        lease = lease_plan.acquire(spark, place, 4)
    finally:
        lease_plan.files.write_once = kept
    assert lease.number == 5 and lease.owner != "0000" and lease.is_newest(spark)
    lease.release(spark)
    assert lease_plan.acquire(spark, place, 4).number == 6 and not lease.is_newest(spark)


def test_a_load_reads_its_run_once(spark, lake):
    """The rows, their checks and their digest come from one scan of the run's daily sales."""
    entries = read_manifest(spark, lake, "sample")
    stage = observed_stage(read_listed_daily_sales(spark, lake, "sample", entries), Observation("o"))
    text = stage._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet") == 1 and text.count("CollectMetrics") >= 1
    assert "Exchange hashpartitioning" not in text


def test_a_load_that_dies_before_its_commit_is_invisible(spark, lake, tmp_path, monkeypatch):
    mart = str(tmp_path)
    promote_run(spark, lake, mart, "small")

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(promote_plan.files, "write_once", dies)
        with pytest.raises(OSError, match="lost"):
            promote_run(spark, lake, mart, "sample")
    assert len(mart_rows(spark, mart)) == 1
    assert promote_run(spark, lake, mart, "sample")["loaded"]
    assert mart_rows(spark, mart) == SAMPLE_DAILY


@pytest.fixture
def stage(spark):
    day = datetime(2026, 1, 1).date()
    return spark.createDataFrame(
        [(day, "US", name, 1, 1, 1, None, None, None) for name in ("a", "b")], DAILY_SALES
    ).fillna({"category": ""}).selectExpr(
        "order_date", "country", "category", "order_count", "line_count", "units",
        *(f"cast(1 as decimal(18,2)) as {name}" for name in
          ("gross_amount", "discount_amount", "net_amount")),
    )


def test_load_operators_follow_the_audit(spark, stage):
    audit = spark.createDataFrame([("r1", NOW, 2)], LOAD_AUDIT)
    mart = incoming_rows(stage, audit.filter("false"), "r1", NOW)
    assert mart.schema.names == MART.names and mart.count() == 2
    # A replay keeps the mart; any other run replaces it.
    assert surviving_rows(mart, audit, "r1").count() == 2
    assert incoming_rows(stage, audit, "r1", NOW).count() == 0
    assert audit_entry(stage, audit, "r1", NOW).count() == 0
    assert surviving_rows(mart, audit, "r2").count() == 0
    assert incoming_rows(stage, audit, "r2", NOW).count() == 2
    assert audit_entry(stage, audit, "r2", NOW).first().row_count == 2
    assert audit_entry(stage.filter("false"), audit, "r2", NOW).first().row_count == 0
    after = mart_after_load(mart, stage.limit(1), audit, "r2", NOW).collect()
    assert [row.source_run_id for row in after] == ["r2"]


def test_rows_that_do_not_fit_the_mart_are_found(spark, stage, lake, tmp_path, monkeypatch):
    assert misfits(stage).isEmpty()
    for name, value in {
        "country": "'USA'", "category": "repeat('é', 51)", "net_amount": "NULL",
        "order_date": "NULL",
    }.items():
        kind = dict(stage.dtypes)[name]
        broken = stage.selectExpr(*(
            f"cast({value} as {kind}) as {name}" if column == name else column
            for column in stage.columns
        ))
        assert misfits(broken).count() == 2, name
    monkeypatch.setattr(promote_plan, "misfit", lambda: F.lit(True))
    with pytest.raises(MartLoadError):
        promote_run(spark, lake, str(tmp_path), "sample")
    assert audited(spark, str(tmp_path)) == []


def test_reconciliation_compares_rows_and_cents(spark, lake, tmp_path):
    found = reconcile_run(spark, lake, "sample")
    assert (found["gold_rows"], found["invalid_rows"]) == (len(SAMPLE_DAILY), 0)
    lines, units = (sum(row[at] for row in SAMPLE_DAILY) for at in (4, 5))
    assert (found["line_count"], found["units"], found["net_revenue"]) == (lines, units, SAMPLE_NET)
    assert reconcile_run(spark, lake, "none")["gold_rows"] == 0
    raw = write_csv(tmp_path / "raw", "a.csv", [csv_line()])
    for run_id, change in {"cents": {"net_amount": "24.01"}, "rows": {"gold_rows": 2}}.items():
        publish_snapshot(spark, raw, str(tmp_path), run_id)
        marker = tmp_path / "manifests" / run_id / "success.json"
        record = json.loads(marker.read_text())
        (marker.parent / ".success.json.crc").unlink()
        marker.write_text(json.dumps({**record, **change}))
        with pytest.raises(QualityError, match="does not reconcile"):
            promote_run(spark, str(tmp_path), str(tmp_path / "mart"), run_id)
    assert audited(spark, str(tmp_path / "mart")) == []


def test_resuming_checks_identity_and_loads_without_a_rebuild(spark, lake, tmp_path):
    checked = resume_run(spark, lake, "sample", "2026-01-20")
    assert checked["metrics"]["valid_rows"] == len(CURRENT) and "load" not in checked
    loaded = resume_run(spark, lake, "sample", "2026-01-20", str(tmp_path))
    assert loaded["load"]["loaded"]
    with pytest.raises(MarkerError):
        resume_run(spark, lake, "sample", "2026-01-19", str(tmp_path))


def test_the_catalog_shows_the_last_load(spark, lake, tmp_path):
    mart = str(tmp_path / "mart x")
    show_mart(spark, "mart_test", mart)
    view, runs = "mart_test.daily_sales", "mart_test.pipeline_runs"
    assert spark.table(view).schema.names == MART.names and spark.table(view).count() == 0
    for run_id, count in (("small", 1), ("sample", len(SAMPLE_DAILY)), ("none", 0)):
        promote_run(spark, lake, mart, run_id)  # the views follow by themselves
        assert spark.table(view).count() == count
        checks = spark.table("mart_test.daily_sales_checks").first()
        assert tuple(checks) == (count, 0, 0, 0, 0, min(1, count))
    listed = spark.table(runs).orderBy("sequence").select("run_id", "row_count").collect()
    assert [tuple(row) for row in listed] == [("small", 1), ("sample", len(SAMPLE_DAILY)), ("none", 0)]
