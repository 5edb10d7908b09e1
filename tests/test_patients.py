"""Patients: created through the endpoint, mapped by its answers, ambiguous ones held back."""

import json
import os
import shutil
from datetime import datetime, timezone

import pytest

from chartpost.operators.patients import fold_patient_map, map_patients, mark_unmapped
from chartpost.plans.jobs import Endpoint, register_and_score, register_patients, score_and_deliver
from chartpost.policies import Breaker, Retries
from chartpost.schemas import PATIENT_MEASUREMENTS
from chartpost.sources.tables import drop_finished_plans, read_table

AT = datetime(2025, 6, 15, 10, 30, tzinfo=timezone.utc)
BASE = "https://fhir.example"
FINE = (37.0, 70, 15, 120, 80, 98.0, 7.0, 1.0, 1.0, 200)
PEOPLE = "patient_id STRING, name STRING"
MAP = "patient_id STRING, endpoint_patient_id STRING"


def endpoint(calls, **settings):
    """Creates patients by name: ``Bad`` is refused, ``Odd`` gets no id, ``Old`` is there before."""

    def open_transport():
        def send(url, headers, body):
            resource = json.loads(body)
            with open(calls, "a") as log:
                if url.endswith("/Patient"):
                    source = resource["identifier"][0]["value"]
                    given = resource["name"][0]["given"][0]
                    assert headers["If-None-Exist"] == f"identifier=urn:chartpost:patient|{source}"
                    log.write(f"create {source}\n")
                    if given == "Bad":
                        return 422, "refused"
                    if given == "Odd":
                        return 201, "{}"
                    return 200 if given == "Old" else 201, json.dumps({"id": f"f-{source}"})
                log.write(f"send {resource['subject']['reference']}\n")
                return 201, json.dumps({"id": "o"})

        return send

    defaults = {"retry": Retries(times=1), "circuit": None, "sleep": lambda seconds: None}
    return Endpoint("generic_fhir", "fhir", BASE, open_transport, **{**defaults, **settings})


@pytest.fixture
def calls(tmp_path):
    return str(tmp_path / "calls")


def lines(calls):
    return sorted(open(calls).read().split("\n")[:-1]) if os.path.exists(calls) else []


def people(spark, *rows):
    return spark.createDataFrame(list(rows), PEOPLE)


def statuses(links):
    return {r.patient_id: (r.status, r.endpoint_patient_id, r.error_message) for r in links.collect()}


def test_created_known_and_failed(spark, workspace, calls):
    asked = people(spark, ("p1", "New One"), ("p1", "New One"), ("p2", "Old Two"), ("p3", "Bad Three"), ("p4", "Odd"), (None, "No Id"))
    links = register_patients(spark, workspace, asked, endpoint(calls), "b1")
    assert statuses(links) == {
        "p1": ("created", "f-p1", None),
        "p2": ("known", "f-p2", None),
        "p3": ("failed", None, "HTTP 422: refused"),
        "p4": ("failed", None, "Invalid response body"),
    }
    assert lines(calls) == ["create p1", "create p2", "create p3", "create p3", "create p4"]
    # The next batch asks only for those who failed.
    again = register_patients(spark, workspace, asked, endpoint(calls), "b2")
    assert set(statuses(again)) == {"p3", "p4"}
    # A finished batch sends nothing.
    n = len(lines(calls))
    register_patients(spark, workspace, asked, endpoint(calls), "b1")
    assert len(lines(calls)) == n
    assert drop_finished_plans(spark, workspace) == 2


def test_restart_creates_nobody_twice(spark, workspace, calls):
    asked = people(spark, ("p1", "New One"), ("p2", "Old Two"), ("p3", "New Three"))
    register_patients(spark, workspace, asked, endpoint(calls, max_rows_per_wave=1), "b1")
    n = len(lines(calls))
    # Died before the answers became links, and with one wave's log lost.
    shutil.rmtree(workspace.path("patient_links/batch_id=b1.patients"))
    links = register_patients(spark, workspace, asked, endpoint(calls), "b1")
    assert len(lines(calls)) == n and {s for s, *_ in statuses(links).values()} == {"created", "known"}
    # People who are added to a batch that is under way wait for the next one.
    assert links.count() == 3


def test_an_open_circuit_holds_creates_back(spark, workspace, calls):
    bad = people(spark, *[(f"p{k}", "Bad") for k in range(4)])
    target = endpoint(calls, max_concurrency=1, circuit=Breaker(limit=2), retry=Retries(times=0))
    first = statuses(register_patients(spark, workspace, bad, target, "b1"))
    assert len(lines(calls)) == 2 and sum(e == "Circuit breaker open" for *_, e in first.values()) == 2
    later = statuses(register_patients(spark, workspace, people(spark, ("n", "New")), target, "b2"))
    assert later == {"n": ("failed", None, "Circuit breaker open")} and len(lines(calls)) == 2


def measured(spark, *ids):
    return spark.createDataFrame([(p, "A B", 50, *FINE, AT) for p in ids], PATIENT_MEASUREMENTS)


def test_scores_go_to_the_ids_the_endpoint_gave(spark, workspace, calls):
    asked = people(spark, ("p1", "New One"), ("p2", "Old Two"), ("p3", "Bad Three"))
    cohort = measured(spark, "p1", "p2", "p3", "p9")
    row = register_and_score(spark, workspace, asked, cohort, endpoint(calls), "b1").first()
    assert (row.succeeded, row.quarantined) == (4, 2)
    assert [x for x in lines(calls) if x.startswith("send")] == ["send Patient/f-p1"] * 2 + ["send Patient/f-p2"] * 2
    aside = read_table(spark, workspace, "quarantine").collect()
    assert {(r.patient_id, r.failed_rules) for r in aside} == {("p3", "mapped_patient"), ("p9", "mapped_patient")}


def test_a_patient_with_two_ids_is_sent_nowhere(spark, workspace, calls):
    known = spark.createDataFrame([("p1", "a"), ("p1", "b"), ("p2", "c"), ("p2", "c"), ("p3", None), (None, "x")], MAP)
    cohort = measured(spark, "p1", "p2", "p3")
    row = score_and_deliver(spark, workspace, cohort, known, endpoint(calls), "b1").first()
    assert (row.total, row.quarantined) == (2, 2) and lines(calls) == ["send Patient/c"] * 2
    aside = read_table(spark, workspace, "quarantine").collect()
    assert {(r.patient_id, r.failed_rules) for r in aside} == {("p1", "ambiguous_patient"), ("p3", "mapped_patient")}
    assert map_patients(cohort, known).count() == 1 and mark_unmapped(cohort, known).count() == 3
    assert fold_patient_map(known).where("patient_id = 'p1'").first().ambiguous
