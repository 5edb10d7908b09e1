"""Batches read changed dates and what was left over, and still see every row."""

import json
import os
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest

from chartpost.operators.backlog import on_dates
from chartpost.plans.jobs import Endpoint, run_delivery_batch
from chartpost.policies import Retries
from chartpost.schemas import READY
from chartpost.sources.tables import append_rows, drop_finished_plans, read_table

AT = datetime(2025, 6, 15, 10, 30, tzinfo=timezone.utc)


def add(spark, workspace, day, *patients, value=42.0):
    at = AT + timedelta(days=day)
    rows = [
        (p, None, "59408-5", None, "SpO2", value, None, None, "%", AT, None, None, at + timedelta(seconds=n), at.date())
        for n, p in enumerate(patients)
    ]
    append_rows(spark.createDataFrame(rows, READY), workspace, "observations_ready")


def endpoint(calls, refuse=()):
    def open_transport():
        def send(url, headers, body):
            patient = json.loads(body)["subject"]["reference"].split("/")[1]
            with open(calls, "a") as log:
                log.write(f"{patient}\n")
            return (503, "busy") if patient in refuse else (201, json.dumps({"id": patient}))

        return send

    return Endpoint("generic_fhir", "fhir", "https://x", open_transport, retry=Retries(times=0), circuit=None, sleep=lambda s: None)


@pytest.fixture
def calls(tmp_path):
    return str(tmp_path / "calls")


def taken(calls):
    """What was sent since the last look."""
    if not os.path.exists(calls):
        return []
    with open(calls) as log:
        found = sorted(log.read().split())
    os.remove(calls)
    return found


def test_old_rows_first_and_none_twice(spark, workspace, calls):
    add(spark, workspace, 0, "a", "b", "c")
    assert run_delivery_batch(spark, workspace, endpoint(calls), "b1", limit=2).first().succeeded == 2
    assert taken(calls) == ["a", "b"]
    add(spark, workspace, 1, "d", "a")
    add(spark, workspace, 0, "e")
    row = run_delivery_batch(spark, workspace, endpoint(calls), "b2", limit=2).first()
    # The late row of the first date and the one left over come before the new date; a is skipped
    # as often as it is there, b once.
    assert taken(calls) == ["c", "e"] and (row.succeeded, row.skipped) == (2, 3)
    row = run_delivery_batch(spark, workspace, endpoint(calls), "b3", limit=None).first()
    assert taken(calls) == ["d"] and (row.succeeded, row.skipped, row.total) == (1, 5, 6)
    assert run_delivery_batch(spark, workspace, endpoint(calls), "b4").first().skipped == 6 and not taken(calls)


def test_dates_that_did_not_change_are_not_read(spark, workspace, calls):
    add(spark, workspace, 0, "a", "b")
    add(spark, workspace, 1, "c")
    run_delivery_batch(spark, workspace, endpoint(calls, refuse=("b",)), "b1", limit=None)
    assert taken(calls) == ["a", "b", "c"]
    # Other rows take the place of the second date's, as many: whoever reads them would send them.
    path = workspace.path(f"observations_ready/queued_date={(AT + timedelta(days=1)).date()}")
    other = spark.read.parquet(path).collect()
    shown = [r.asDict() | {"patient_id": "unseen"} for r in other]
    schema = spark.read.parquet(path).schema
    spark.createDataFrame(shown, schema).write.mode("overwrite").parquet(path)
    add(spark, workspace, 2, "d")
    row = run_delivery_batch(spark, workspace, endpoint(calls), "b2", limit=None).first()
    assert taken(calls) == ["b", "d"] and (row.succeeded, row.skipped) == (2, 2)


def test_the_scan_skips_other_folders(spark, workspace):
    for day in range(5):
        add(spark, workspace, day, "p")
    ready = read_table(spark, workspace, "observations_ready")
    some = ready.where(on_dates([(AT + timedelta(days=3)).date()]))
    assert some.count() == 1 and len(some.select("_metadata.file_path").distinct().collect()) == 1
    plan = some._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "queued_date" in filters and ready.where(on_dates([])).count() == 0


def test_duplicates_across_dates_and_refused_rows(spark, workspace, calls):
    add(spark, workspace, 0, "a", "a", "b")
    add(spark, workspace, 1, "a")
    add(spark, workspace, 1, "n", value=float("nan"))
    row = run_delivery_batch(spark, workspace, endpoint(calls, refuse=("a",)), "b1", limit=None).first()
    assert (row.succeeded, row.dead_lettered, row.skipped, row.quarantined) == (1, 1, 2, 1)
    row = run_delivery_batch(spark, workspace, endpoint(calls), "b2", limit=None).first()
    assert (row.succeeded, row.skipped, row.total, row.quarantined) == (1, 3, 4, 0)
    assert taken(calls) == ["a", "a", "b"]


def test_each_endpoint_has_its_own_backlog_and_old_states_go(spark, workspace, calls):
    add(spark, workspace, 0, "a", "b")
    for k in range(4):
        run_delivery_batch(spark, workspace, endpoint(calls), f"b{k}", limit=1)
    assert taken(calls) == ["a", "b"]
    other = replace(endpoint(calls), ehr_system="cerner")
    assert run_delivery_batch(spark, workspace, other, "c1", limit=None).first().succeeded == 2
    states = {r.batch_id for r in read_table(spark, workspace, "ready_dates").select("batch_id").collect()}
    assert states == {"b2", "b3", "c1"} and drop_finished_plans(spark, workspace) == 5


def test_an_empty_ready_table(spark, workspace, calls):
    row = run_delivery_batch(spark, workspace, endpoint(calls), "b1").first()
    assert (row.total, row.quarantined) == (0, 0) and not taken(calls)
