"""Sending, retries, circuit and restarts, against in-process endpoints."""

import json
import os
import shutil
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from chartpost.operators.dead_letters import pending_letters
from chartpost.operators.delivery import http_transport
from chartpost.operators.ledger import current_ledger
from chartpost.operators.normalize import to_observations
from chartpost.operators.outcomes import CIRCUIT_OPEN
from chartpost.plans.jobs import (
    Endpoint,
    compact_ledger,
    deliver_observations,
    reprocess_dead_letters,
    reprocess_endpoint,
    run_delivery_batch,
    score_and_deliver,
    validate_run,
)
from chartpost.policies import Breaker, Retries
from chartpost.schemas import PATIENT_MEASUREMENTS, READY
from chartpost.sources.tables import (
    Workspace,
    append_rows,
    drop_finished_plans,
    ensure_tables,
    read_table,
)

AT = datetime(2025, 6, 15, 10, 30, tzinfo=timezone.utc)
BASE = "https://fhir.example"


def ready(spark, workspace, patients, value=42.0, typed=(None, None)):
    rows = [
        (p, None, "59408-5", None, "SpO2", value, *typed, "%", AT, None, None, AT + timedelta(seconds=n), AT.date())
        for n, p in enumerate(patients)
    ]
    append_rows(spark.createDataFrame(rows, READY), workspace, "observations_ready")


def endpoint(calls, fail_first=0, always_fail=False, status=503, **settings):
    """Endpoint answering ``fhir-<patient>``; every request is appended to a file."""

    def open_transport():
        seen = {}

        def send(url, headers, body):
            patient = json.loads(body)["subject"]["reference"].split("/")[1]
            seen[patient] = seen.get(patient, 0) + 1
            with open(calls, "a") as log:
                log.write(f"{patient} {headers.get('Authorization', '-')}\n")
            if always_fail or seen[patient] <= fail_first:
                return status, "busy"
            return 201, json.dumps({"id": f"fhir-{patient}"})

        return send

    defaults = {"retry": Retries(), "sleep": lambda seconds: None}
    return Endpoint("generic_fhir", "fhir", BASE, open_transport, **{**defaults, **settings})


@pytest.fixture
def calls(tmp_path):
    return str(tmp_path / "calls")


def sent(calls):
    return open(calls).read().split("\n")[:-1] if os.path.exists(calls) else []


def ledger(spark, workspace):
    return current_ledger(read_table(spark, workspace, "delivery_ledger"))


def test_single(spark, workspace, calls):
    ready(spark, workspace, ["P100"])
    row = run_delivery_batch(spark, workspace, endpoint(calls), "b1").first()
    assert (row.succeeded, row.total, row.success_rate) == (1, 1, 1.0)
    stored = ledger(spark, workspace).first()
    assert (stored.ehr_resource_id, stored.status, stored.retry_count) == ("fhir-P100", "success", 0)


def test_batch_of_five(spark, workspace, calls):
    ready(spark, workspace, [f"P{n}" for n in range(5)])
    row = run_delivery_batch(spark, workspace, endpoint(calls), "b1").first()
    assert (row.succeeded, row.success_rate) == (5, 1.0)


def test_repeat_is_skipped(spark, workspace, calls):
    ready(spark, workspace, ["P100"])
    run_delivery_batch(spark, workspace, endpoint(calls), "b1")
    row = run_delivery_batch(spark, workspace, endpoint(calls), "b2").first()
    assert (row.succeeded, row.skipped) == (0, 1)
    assert len(sent(calls)) == 1


def test_same_batch_id_is_not_sent_again(spark, workspace, calls):
    ready(spark, workspace, ["P1"])
    first = run_delivery_batch(spark, workspace, endpoint(calls, always_fail=True), "b1").first()
    n = len(sent(calls))
    again = run_delivery_batch(spark, workspace, endpoint(calls, always_fail=True), "b1").first()
    assert first == again and len(sent(calls)) == n


def test_retry_then_success(spark, workspace, calls):
    ready(spark, workspace, ["P100"])
    run_delivery_batch(spark, workspace, endpoint(calls, fail_first=2), "b1")
    row = ledger(spark, workspace).first()
    assert (row.status, row.retry_count) == ("success", 2)


def test_exhausted(spark, workspace, calls):
    ready(spark, workspace, ["P100"])
    settings = {"circuit": Breaker(limit=100)}
    row = run_delivery_batch(
        spark, workspace, endpoint(calls, always_fail=True, **settings), "b1"
    ).first()
    assert (row.succeeded, row.dead_lettered) == (0, 1)
    letter = pending_letters(read_table(spark, workspace, "dead_letters")).first()
    assert (letter.retry_count, letter.last_error) == (3, "HTTP 503: busy")
    assert ledger(spark, workspace).first().status == "dead_lettered"
    assert len(sent(calls)) == 4


def test_circuit_opens(spark, workspace, calls):
    """Two rows make three failures; the third row is not sent."""
    ready(spark, workspace, ["P1", "P2", "P3"])
    failing = endpoint(
        calls,
        always_fail=True,
        retry=Retries(times=1),
        circuit=Breaker(limit=3),
        max_concurrency=1,
    )
    row = run_delivery_batch(spark, workspace, failing, "b1").first()
    assert row.dead_lettered == 3
    letters = {
        r.patient_id: r
        for r in pending_letters(read_table(spark, workspace, "dead_letters")).collect()
    }
    assert letters["P3"].last_error == CIRCUIT_OPEN and letters["P3"].retry_count == 0
    assert letters["P2"].last_error == "HTTP 503: busy" and letters["P2"].retry_count == 1
    assert len(sent(calls)) == 3


def test_open_circuit_gates_the_next_batch(spark, workspace, calls):
    ready(spark, workspace, ["P1", "P2"])
    failing = endpoint(calls, always_fail=True, circuit=Breaker(limit=3))
    run_delivery_batch(spark, workspace, failing, "b1")
    n = len(sent(calls))
    row = run_delivery_batch(spark, workspace, endpoint(calls), "b2").first()
    assert row.dead_lettered == 2 and len(sent(calls)) == n
    recovered = endpoint(calls, circuit=Breaker(rest_seconds=0.0))
    assert run_delivery_batch(spark, workspace, recovered, "b3").first().succeeded == 2


def test_mixed(spark, workspace, calls):
    ready(spark, workspace, ["P1"])
    run_delivery_batch(spark, workspace, endpoint(calls), "b1")
    ready(spark, workspace, ["P2", "P3"])
    row = run_delivery_batch(spark, workspace, endpoint(calls), "b2").first()
    assert (row.skipped, row.succeeded, row.total) == (1, 2, 3)


def test_duplicates_are_sent_once(spark, workspace, calls):
    ready(spark, workspace, ["P1"] * 40 + ["P2"])
    row = run_delivery_batch(spark, workspace, endpoint(calls), "b1").first()
    assert (row.succeeded, row.skipped, row.total) == (2, 39, 41)
    assert sorted(c.split()[0] for c in sent(calls)) == ["P1", "P2"]


def test_limit_does_not_starve(spark, workspace, calls):
    ready(spark, workspace, [f"P{n}" for n in range(6)])
    for batch_id in ("b1", "b2", "b3"):
        row = run_delivery_batch(spark, workspace, endpoint(calls), batch_id, limit=2).first()
        assert row.succeeded == 2
    assert ledger(spark, workspace).where("status = 'success'").count() == 6


def test_quarantine(spark, workspace, calls):
    ready(spark, workspace, ["P1"])
    ready(spark, workspace, ["P2"], value=None)
    ready(spark, workspace, ["P3"], value=float("nan"))
    row = run_delivery_batch(spark, workspace, endpoint(calls), "b1").first()
    assert row.total == 1
    bad = read_table(spark, workspace, "quarantine").collect()
    assert sorted((r.patient_id, r.failed_rules) for r in bad) == [
        ("P2", "valid_value"),
        ("P3", "valid_value"),
    ]


def test_token_reaches_the_request_only(spark, workspace, calls):
    ready(spark, workspace, ["P1"])
    run_delivery_batch(spark, workspace, endpoint(calls, token_provider=lambda: "s3cret"), "b1")
    assert sent(calls) == ["P1 Bearer s3cret"]
    assert "s3cret" not in str(read_table(spark, workspace, "attempt_log").collect())


def test_not_retryable_status(spark, workspace, calls):
    ready(spark, workspace, ["P1"])
    policy = Retries(statuses=frozenset({503}))
    run_delivery_batch(
        spark, workspace, endpoint(calls, always_fail=True, status=400, retry=policy), "b1"
    )
    assert len(sent(calls)) == 1


@pytest.mark.parametrize(
    "answer,error",
    [
        ((200, "not json"), "Invalid response body"),
        ((200, "[1]"), "Invalid response body"),
        ((302, ""), "HTTP 302: "),
        (OSError("refused"), "Connection error: refused"),
    ],
)
def test_bad_answers_fail_one_row(spark, workspace, answer, error):
    ready(spark, workspace, ["P1"])

    def open_transport():
        def send(url, headers, body):
            if isinstance(answer, Exception):
                raise answer
            return answer

        return send

    target = Endpoint("generic_fhir", "fhir", BASE, open_transport, sleep=lambda s: None)
    row = run_delivery_batch(spark, workspace, target, "b1").first()
    assert row.dead_lettered == 1
    assert ledger(spark, workspace).first().error_message == error


def test_restart_after_sending(spark, workspace, calls):
    """A batch that stopped between sending and recording is finished without sending."""
    ready(spark, workspace, ["P1", "P2"])
    run_delivery_batch(spark, workspace, endpoint(calls), "b1")
    other = Workspace(workspace.root + "-restarted")
    ensure_tables(spark, other)
    for part in ("plans/b1/classified", "plans/b1/waves", "attempt_log/batch_id=b1/wave=0"):
        shutil.copytree(workspace.path(part), other.path(part))
    ready(spark, other, ["P1", "P2"])
    row = run_delivery_batch(spark, other, endpoint(calls), "b1").first()
    assert row.succeeded == 2 and len(sent(calls)) == 2
    assert ledger(spark, other).count() == 2


def test_waves(spark, workspace, calls):
    """Each wave sends a part, oldest first; a lost log is the only wave sent again."""
    ready(spark, workspace, [f"P{n}" for n in range(10)])
    small = endpoint(calls, max_rows_per_wave=3, max_concurrency=1)
    assert run_delivery_batch(spark, workspace, small, "b1").first().succeeded == 10
    order = [c.split()[0] for c in sent(calls)]
    assert sorted(order) == [f"P{n}" for n in range(10)] and order[0] == "P0"
    attempts = read_table(spark, workspace, "attempt_log")
    sizes = [r["count"] for r in attempts.groupBy("wave").count().collect()]
    assert len(sizes) > 1 and sum(sizes) == 10

    lost = attempts.where("wave = 1").count()
    other = Workspace(workspace.root + "-lost-wave")
    ensure_tables(spark, other)
    for part in ("plans/b1/classified", "plans/b1/waves"):
        shutil.copytree(workspace.path(part), other.path(part))
    for wave in range(len(sizes)):
        part = f"attempt_log/batch_id=b1/wave={wave}"
        if wave != 1:
            shutil.copytree(workspace.path(part), other.path(part))
    ready(spark, other, [f"P{n}" for n in range(10)])
    assert run_delivery_batch(spark, other, small, "b1").first().succeeded == 10
    assert len(sent(calls)) == 10 + lost


def test_circuit_opened_by_one_wave_holds_back_the_next(spark, workspace, calls):
    ready(spark, workspace, [f"P{n}" for n in range(8)])
    failing = endpoint(
        calls,
        always_fail=True,
        retry=Retries(times=0),
        circuit=Breaker(limit=2),
        max_rows_per_wave=2,
        max_concurrency=1,
    )
    assert run_delivery_batch(spark, workspace, failing, "b1").first().dead_lettered == 8
    errors = [r.error_message for r in ledger(spark, workspace).collect()]
    assert errors.count(CIRCUIT_OPEN) == 8 - len(sent(calls)) >= 5


def test_reprocess(spark, workspace, calls):
    ready(spark, workspace, ["P1", "P2"])
    open_wide = {"circuit": None}
    run_delivery_batch(spark, workspace, endpoint(calls, always_fail=True, **open_wide), "b1")
    letters = read_table(spark, workspace, "dead_letters")
    assert pending_letters(letters).count() == 2

    still = reprocess_endpoint(endpoint(calls, always_fail=True, **open_wide))
    assert reprocess_dead_letters(spark, workspace, still, "r1").first().dead_lettered == 2
    letters = read_table(spark, workspace, "dead_letters")
    assert pending_letters(letters).count() == 2  # one per key, however often it fails
    assert {r.retry_count for r in pending_letters(letters).collect()} == {1}

    fine = reprocess_endpoint(endpoint(calls, **open_wide))
    assert reprocess_dead_letters(spark, workspace, fine, "r2").first().succeeded == 2
    assert pending_letters(read_table(spark, workspace, "dead_letters")).count() == 0
    assert {r.status for r in ledger(spark, workspace).collect()} == {"success"}


def test_reprocess_of_delivered_key_is_marked(spark, workspace, calls):
    ready(spark, workspace, ["P1"])
    run_delivery_batch(spark, workspace, endpoint(calls, always_fail=True, circuit=None), "b1")
    run_delivery_batch(spark, workspace, endpoint(calls, circuit=None), "b2")
    n = len(sent(calls))
    row = reprocess_dead_letters(spark, workspace, endpoint(calls, circuit=None), "r1").first()
    assert row.skipped == 1 and len(sent(calls)) == n
    assert pending_letters(read_table(spark, workspace, "dead_letters")).count() == 0


def test_score_and_deliver(spark, workspace, calls):
    sick = (39.0, 120, 30, 90, 50, 97.0, 15.0, 5.0, 1.0, 200)
    fine = (37.0, 70, 15, 120, 80, 98.0, 7.0, 1.0, 1.0, 200)
    rows = [(p, "A B", 50, *m, AT) for p, m in (("p1", sick), ("p2", fine), ("p3", fine))]
    measured = spark.createDataFrame(rows, PATIENT_MEASUREMENTS)
    known = spark.createDataFrame(
        [("p1", "f1"), ("p2", "f2")], "patient_id STRING, endpoint_patient_id STRING"
    )
    row = score_and_deliver(spark, workspace, measured, known, endpoint(calls), "s1").first()
    assert (row.succeeded, row.quarantined) == (4, 1)
    assert sorted({c.split()[0] for c in sent(calls)}) == ["f1", "f2"]
    aside = read_table(spark, workspace, "quarantine").first()
    assert (aside.patient_id, aside.failed_rules) == ("p3", "mapped_patient")
    assert json.loads(aside.row_json)["lactate"] == 1.0


def test_no_measurement_is_lost(spark, workspace, calls):
    fine = (37.0, 70, 15, 120, 80, 98.0, 7.0, 1.0, 1.0, 200)
    broken = (37.0, None, 15, 120, 80, 98.0, float("nan"), 1.0, 1.0, 200)
    rows = [(p, "A B", 50, *fine, None) for p in ("p1", "p2", "p3")]
    rows += [("p1", "A B", 50, *broken, AT), (None, "A B", 50, *fine, AT), ("p1", "A B", 50, *fine, AT)]
    measured = spark.createDataFrame(rows, PATIENT_MEASUREMENTS)
    known = spark.createDataFrame([("p1", "f1")], "patient_id STRING, endpoint_patient_id STRING")
    row = score_and_deliver(spark, workspace, measured, known, endpoint(calls), "s1").first()
    assert (row.total, row.succeeded, row.quarantined) == (2, 2, 5)
    reasons = sorted(r.failed_rules for r in read_table(spark, workspace, "quarantine").collect())
    assert reasons == ["valid_measured_at"] * 3 + ["valid_patient", "valid_wbc_count,valid_heart_rate"]


def test_observations_without_a_key_are_put_aside(spark, workspace, calls):
    rows = spark.createDataFrame(
        [("P1", "c", 1.0, AT), ("P2", "c", 1.0, None), ("P3", None, 1.0, AT), (None, "c", 1.0, AT), ("P4", "c", None, AT)],
        "patient_id STRING, observation_code STRING, value DOUBLE, effective_datetime TIMESTAMP",
    )
    blank = ("encounter_id", "code_system", "display_name", "unit", "source_system")
    rows = rows.withColumns({name: F.lit(None).cast("string") for name in blank})
    observations = to_observations(rows).withColumn("queued_at", F.lit(AT))
    row = deliver_observations(spark, workspace, observations, endpoint(calls), "b1").first()
    assert (row.succeeded, row.total, row.quarantined) == (1, 1, 4)


def test_texts_and_booleans_are_sent_as_such(spark, workspace, tmp_path):
    bodies = str(tmp_path / "bodies")

    def open_transport():
        def send(url, headers, body):
            with open(bodies, "a") as log:
                log.write(body + "\n")
            return 201, '{"id":"x"}'

        return send

    ready(spark, workspace, ["P1"], value=None, typed=("high", None))
    ready(spark, workspace, ["P2"], value=None, typed=(None, True))
    target = Endpoint("generic_fhir", "fhir", BASE, open_transport, sleep=lambda s: None)
    assert run_delivery_batch(spark, workspace, target, "b1").first().succeeded == 2
    sent_values = [json.loads(line) for line in open(bodies)]
    assert {v.get("valueString") for v in sent_values} == {"high", None}
    assert {v.get("valueBoolean") for v in sent_values} == {True, None}


def test_unknown_route_is_refused(spark, workspace, calls):
    ready(spark, workspace, ["P1"])
    with pytest.raises(ValueError, match="no route epic/flow"):
        run_delivery_batch(spark, workspace, replace(endpoint(calls), ehr_system="epic", api="flow"), "b1")
    assert read_table(spark, workspace, "delivery_batches").count() == 0


def test_limit_stores_only_what_it_sends(spark, workspace, calls):
    ready(spark, workspace, [f"P{n}" for n in range(60)])
    run_delivery_batch(spark, workspace, endpoint(calls), "b1", limit=20)
    row = run_delivery_batch(spark, workspace, endpoint(calls), "b2", limit=10).first()
    assert (row.succeeded, row.skipped) == (10, 20)
    stored = spark.read.parquet(workspace.path("plans/b2/classified"))
    assert stored.where("outcome = 'new'").count() == 10
    assert stored.where("outcome <> 'new'").count() == 1


def test_quarantine_does_not_grow_with_reruns(spark, workspace, calls):
    ready(spark, workspace, [f"P{n}" for n in range(7)], value=None)
    assert run_delivery_batch(spark, workspace, endpoint(calls), "b1").first().quarantined == 7
    ready(spark, workspace, ["P9"], value=float("inf"))
    assert run_delivery_batch(spark, workspace, endpoint(calls), "b2").first().quarantined == 1
    assert read_table(spark, workspace, "quarantine").count() == 8


def test_half_written_ledger_is_written_again(spark, workspace, calls):
    """Files of a commit that died are no ledger; the restart writes all rows, sends none."""
    ready(spark, workspace, [f"P{n}" for n in range(12)])
    run_delivery_batch(spark, workspace, endpoint(calls), "b1")
    folder = workspace.path("delivery_ledger/batch_id=b1")
    shutil.rmtree(workspace.path("delivery_batches/batch_id=b1"))
    os.remove(f"{folder}/_SUCCESS")
    files = [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]
    os.remove(files[0])
    row = run_delivery_batch(spark, workspace, endpoint(calls), "b1").first()
    assert row.succeeded == 12 and len(sent(calls)) == 12
    assert ledger(spark, workspace).count() == 12


def test_a_token_is_renewed_between_requests(spark, workspace, calls, tmp_path):
    tickets = str(tmp_path / "tickets")

    def provider():
        with open(tickets, "a") as log:
            log.write("x")
        return f"t{os.path.getsize(tickets)}"

    ready(spark, workspace, ["P1", "P2", "P3"])
    run_delivery_batch(spark, workspace, endpoint(calls, token_provider=provider, max_concurrency=1), "b1")
    assert sorted(c.split()[2] for c in sent(calls)) == ["t1", "t2", "t3"]


def test_finished_plans_are_dropped(spark, workspace, calls):
    assert drop_finished_plans(spark, workspace) == 0
    ready(spark, workspace, ["P1", "P2"])
    first = run_delivery_batch(spark, workspace, endpoint(calls), "b1", limit=1).first()
    os.makedirs(workspace.path("plans/b9"))
    assert drop_finished_plans(spark, workspace) == 1
    assert os.listdir(workspace.path("plans")) == ["b9"]
    assert run_delivery_batch(spark, workspace, endpoint(calls), "b1").first() == first
    assert run_delivery_batch(spark, workspace, endpoint(calls), "b2").first().succeeded == 1


def test_completion_markers_must_stay_on(spark, workspace, calls):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        with pytest.raises(RuntimeError, match="markers"):
            run_delivery_batch(spark, workspace, endpoint(calls), "b1")
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_unreadable_letters_are_put_aside_once(spark, workspace, calls):
    ready(spark, workspace, ["P1"])
    run_delivery_batch(spark, workspace, endpoint(calls, always_fail=True, circuit=None), "b1")
    letters = read_table(spark, workspace, "dead_letters")
    broken = letters.withColumns({"observation_json": F.lit("{"), "batch_id": F.lit("b0"), "idempotency_key": F.lit("k")})
    append_rows(broken, workspace, "dead_letters")
    for batch_id in ("r1", "r2"):
        reprocess_dead_letters(spark, workspace, endpoint(calls, circuit=None), batch_id)
    aside = read_table(spark, workspace, "quarantine").collect()
    assert [r.failed_rules for r in aside] == ["readable_letter"]


def test_reports_and_compaction(spark, workspace, calls):
    ready(spark, workspace, ["P1", "P2"])
    run_delivery_batch(spark, workspace, endpoint(calls, always_fail=True, circuit=None), "b1")
    run_delivery_batch(spark, workspace, endpoint(calls, circuit=None), "b2")
    summary = {r.metric: r.n for r in validate_run(spark, workspace)["summary"].collect()}
    assert summary["log_rows"] == 2 and summary["duplicate_idempotency_keys"] == 0
    assert summary["dead_letter_rows"] == 2
    assert read_table(spark, workspace, "delivery_ledger").count() == 4
    target = Workspace(workspace.root + "-compact")
    compact_ledger(spark, workspace, target)
    assert read_table(spark, target, "delivery_ledger").count() == 2


def test_batch_id_and_speculation_are_checked(spark, workspace, calls):
    with pytest.raises(ValueError):
        run_delivery_batch(spark, workspace, endpoint(calls), "a/b")


def test_catalog_tables(spark, workspace):
    ensure_tables(spark, workspace, database="chartpost_test")
    ensure_tables(spark, workspace, database="chartpost_test")
    assert spark.table("chartpost_test.delivery_ledger").count() == 0
    spark.sql("DROP DATABASE chartpost_test CASCADE")


def test_http_transport_reports_an_unreachable_host():
    with pytest.raises(OSError):
        http_transport(0.2)()("http://unreachable.invalid/Observation", {}, "{}")


def test_concurrency_is_the_number_of_partitions(spark):
    from chartpost.operators.delivery import spread_requests

    rows = spark.range(100).select(
        F.sha2(F.col("id").cast("string"), 256).alias("idempotency_key"),
        F.current_timestamp().alias("queued_at"),
        F.current_timestamp().alias("effective_datetime"),
    )
    assert spread_requests(rows, 5).rdd.getNumPartitions() == 5
