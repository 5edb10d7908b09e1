"""Reprocessing reads new letters and the keys left over, and still sees every letter."""

import json
import random
import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from chartpost.operators.dead_letters import (
    changed_batches,
    letters_of,
    pending_keys,
    pending_letters,
    rows_per_part,
)
from chartpost.plans.jobs import Endpoint, reprocess_dead_letters
from chartpost.policies import Retries
from chartpost.schemas import DEAD_LETTER_EVENTS, PENDING_KEYS
from chartpost.sources.tables import append_rows, read_table

AT = datetime(2025, 6, 15, 10, 30, tzinfo=timezone.utc)


def letter(key, batch_id, minute, body=None):
    text = body or json.dumps(
        {
            "patient_id": key, "code": "59408-5", "display_name": "SpO2", "value": 42.0, "unit": "%",
            "code_system": "http://loinc.org", "effective_datetime": "2025-06-15T10:30:00Z", "metadata": {},
            "source_system": "s",
        }
    )
    at = AT + timedelta(minutes=minute)
    return ("dead_lettered", key, key, "59408-5", "generic_fhir", "fhir", text, "busy", 0, 1, at, minute, batch_id, at.date())


def mark(key, batch_id, minute):
    at = AT + timedelta(minutes=minute)
    return ("reprocessed", key, None, None, "generic_fhir", "fhir", None, None, None, None, at, 0, batch_id, at.date())


def add(spark, workspace, *rows):
    append_rows(spark.createDataFrame(rows, DEAD_LETTER_EVENTS), workspace, "dead_letters")


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
    path = tmp_path / "calls"
    path.touch()
    return path


def taken(calls):
    found = sorted(calls.read_text().split())
    calls.write_text("")
    return found


def test_state_equals_a_fold_over_all_events(spark):
    rng = random.Random(4)
    rows = []
    for n in range(12):
        for key in rng.sample("abcdefgh", 4):
            make = letter if rng.random() < 0.7 else mark
            rows.append(make(key, f"b{n}", n))
    # The same event read twice changes nothing.
    steps = [rows[:16], rows[12:32], rows[32:], rows[-4:], []]
    state = spark.createDataFrame([], PENDING_KEYS)
    for k, fresh in enumerate(steps):
        state = pending_keys(state, spark.createDataFrame(fresh, DEAD_LETTER_EVENTS))
        seen = spark.createDataFrame(rows[: (16, 32, 48, 48, 48)[k]], DEAD_LETTER_EVENTS)
        expected = {(r.idempotency_key, r.dead_lettered_at) for r in pending_letters(seen, limit=None).collect()}
        found = state.collect()
        assert {(r.idempotency_key, r.dead_lettered_at) for r in found} == expected
        assert all(r.readable for r in found)
        state = spark.createDataFrame([(*r, "s") for r in found], PENDING_KEYS)
    bodies = letters_of(spark.createDataFrame(rows, DEAD_LETTER_EVENTS), state)
    whole = pending_letters(spark.createDataFrame(rows, DEAD_LETTER_EVENTS), limit=None)
    assert sorted(bodies.collect()) == sorted(whole.collect()) != []


def test_oldest_first_and_broken_ones_take_no_place(spark, workspace, calls):
    add(spark, workspace, letter("a", "b1", 3), letter("b", "b1", 1), letter("k", "b1", 0, body="{"))
    add(spark, workspace, letter("c", "b2", 2), letter("a", "b2", 5))
    row = reprocess_dead_letters(spark, workspace, endpoint(calls, refuse="b"), "r1", limit=2).first()
    assert taken(calls) == ["b", "c"] and (row.succeeded, row.dead_lettered, row.quarantined) == (1, 1, 1)
    add(spark, workspace, letter("d", "b3", 4))
    # b has failed again and stands behind the others now.
    row = reprocess_dead_letters(spark, workspace, endpoint(calls), "r2", limit=2).first()
    assert taken(calls) == ["a", "d"] and (row.succeeded, row.quarantined) == (2, 0)
    row = reprocess_dead_letters(spark, workspace, endpoint(calls), "r3").first()
    assert taken(calls) == ["b"] and row.succeeded == 1
    assert [r.idempotency_key for r in pending_letters(read_table(spark, workspace, "dead_letters")).collect()] == ["k"]
    row = reprocess_dead_letters(spark, workspace, endpoint(calls), "r4").first()
    assert (row.total, row.quarantined) == (0, 0) and not taken(calls)
    states = {r.batch_id for r in read_table(spark, workspace, "letter_parts").select("batch_id").collect()}
    assert states == {"r3", "r4"}


def test_batches_that_did_not_change_are_not_read(spark, workspace, calls):
    add(spark, workspace, letter("a", "b1", 1), letter("b", "b1", 2))
    add(spark, workspace, letter("c", "b2", 3))
    reprocess_dead_letters(spark, workspace, endpoint(calls), "r1", limit=2)
    assert taken(calls) == ["a", "b"]
    # Other letters take the place of the first batch's, as many: whoever reads them would send them.
    path = workspace.path("dead_letters/batch_id=b1/event=dead_lettered")
    held = spark.read.parquet(path)
    rows = held.withColumn("idempotency_key", F.concat("idempotency_key", F.lit("-unseen"))).collect()
    spark.createDataFrame(rows, held.schema).write.mode("overwrite").parquet(path)
    add(spark, workspace, letter("d", "b3", 4))
    reprocess_dead_letters(spark, workspace, endpoint(calls), "r2")
    assert taken(calls) == ["c", "d"]


def test_the_scan_of_letters_skips_other_batches(spark, workspace):
    for n in range(4):
        add(spark, workspace, letter(f"k{n}", f"b{n}", n))
    events = read_table(spark, workspace, "dead_letters")
    before = rows_per_part(events).where("letter_batch <> 'b3'")
    assert changed_batches(rows_per_part(events), before) == ["b3"]
    state = pending_keys(spark.createDataFrame([], PENDING_KEYS), events)
    assert "observation_json" not in state.columns
    bodies = letters_of(events, state.where("idempotency_key = 'k2'"))
    assert [r.patient_id for r in bodies.collect()] == ["k2"]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = letters_of(events, state.where("idempotency_key = 'k2'"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = [part.split("]")[0] for part in plan.split("PartitionFilters: ")[1:]]
    assert any(re.search(r"batch_id#\d+ (=|IN) \(?b2", part) for part in filters), filters


def test_no_letters(spark, workspace, calls):
    row = reprocess_dead_letters(spark, workspace, endpoint(calls), "r1").first()
    assert (row.total, row.quarantined) == (0, 0) and not taken(calls)
