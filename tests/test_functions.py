"""Column functions against Python's own renderings and fixed expectations."""

import hashlib
import json
import math
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from chartpost.functions import payloads, retry, scoring, text, values
from chartpost.functions.keys import idempotency_key
from chartpost.operators.normalize import to_observations, with_key, with_request
from chartpost.policies import Retries
from chartpost.schemas import QUEUE

AT = datetime(2025, 6, 15, 10, 30, tzinfo=timezone.utc)
EXTRA = (
    "patient_id STRING, encounter_id STRING, observation_code STRING, code_system STRING, "
    "display_name STRING, value DOUBLE, value_str STRING, value_bool BOOLEAN, unit STRING, "
    "effective_datetime TIMESTAMP, source_system STRING, metadata_json STRING"
)


def one(spark, **given):
    row = {
        "patient_id": "P100",
        "encounter_id": None,
        "observation_code": "59408-5",
        "code_system": None,
        "display_name": "SpO2",
        "value": None,
        "value_str": None,
        "value_bool": None,
        "unit": None,
        "effective_datetime": AT,
        "source_system": None,
        "metadata_json": None,
        **given,
    }
    return to_observations(spark.createDataFrame([tuple(row.values())], EXTRA))


GOLDEN = {
    ("generic_fhir", "fhir"): "8f5c617c6539b36cb6bfd9063dd584df6638a2fa4eca765f15b2d5be3537cc36",
    ("epic", "fhir"): "156b939a020442bbc41ebc5014d8526ed112d6d1aa9d2d6095f43fdc2bf6a3c7",
    ("cerner", "fhir"): "1958cefc2d5390f466fc74a9cbcf84a0b764d311a4dde88a8f93999a18e16283",
    ("epic", "flowsheet"): "b6eebc69e764b5e3c25e45f74d0aa699161b3d2f69e0e19e90108dbc995821a1",
}


@pytest.mark.parametrize("route", GOLDEN)
def test_keys_per_route(spark, route):
    addressed = with_key(one(spark, value=98.5)).withColumns(
        {"ehr_system": F.lit(route[0]), "api": F.lit(route[1])}
    )
    row = with_request(addressed, "https://x").first()
    assert row.request_id == GOLDEN[route]
    assert row.idempotency_key == GOLDEN["epic", "fhir"]


def test_key_of_incomplete_row_is_null(spark):
    df = spark.range(1).select(
        idempotency_key(F.lit("a"), F.lit(None).cast("string"), F.current_timestamp()).alias("k")
    )
    assert df.first().k is None


def test_instants_like_isoformat(spark):
    instants = [AT, AT.replace(microsecond=120), AT.replace(microsecond=500000)]
    df = spark.createDataFrame([(i,) for i in instants], "ts TIMESTAMP")
    got = df.select(
        text.iso_instant(F.col("ts")).alias("iso"), text.utc_seconds_instant(F.col("ts")).alias("z")
    ).collect()
    assert [r.iso for r in got] == [i.isoformat() for i in instants]
    assert [r.z for r in got] == [i.strftime("%Y-%m-%dT%H:%M:%SZ") for i in instants]


def test_floats_like_python(spark):
    rng = random.Random(7)
    samples = [0.0, -0.0, 1e7, 1e16, 9999999.0, 1e-4, 9.99e-5, 1e-3, 123456789.125, 2e23]
    samples += [1.4213999999999998e16, float("inf"), float("-inf"), 1e22, 1.7976931348623157e308]
    samples += [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 16) for _ in range(5000)]
    samples += [round(rng.uniform(0, 500), 2) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in samples], "v DOUBLE")
    got = df.select("v", text.python_float_text(F.col("v")).alias("t")).collect()
    wrong = [(r.v, r.t) for r in got if r.t != str(r.v)]
    assert wrong == []
    nan = spark.range(1).select(text.python_float_text(F.lit(float("nan"))).alias("t"))
    assert nan.first().t == "nan"


def test_numeric_payload(spark):
    df = one(spark, value=98.5, unit="%", encounter_id="E200")
    body = json.loads(df.select(payloads.fhir_observation().alias("p")).first().p)
    assert body["resourceType"] == "Observation" and body["status"] == "final"
    assert body["category"][0]["coding"][0]["code"] == "survey"
    assert body["code"] == {
        "coding": [{"system": "http://loinc.org", "code": "59408-5", "display": "SpO2"}],
        "text": "SpO2",
    }
    assert body["subject"] == {"reference": "Patient/P100"}
    assert body["encounter"] == {"reference": "Encounter/E200"}
    assert body["effectiveDateTime"] == "2025-06-15T10:30:00+00:00"
    assert body["valueQuantity"] == {
        "value": 98.5,
        "unit": "%",
        "system": "http://unitsofmeasure.org",
    }
    assert "valueString" not in body and "valueBoolean" not in body


@pytest.mark.parametrize(
    "given,name,value",
    [
        ({"value_bool": True}, "valueBoolean", True),
        ({"value_bool": False, "value": 1.0}, "valueBoolean", False),
        ({"value_str": "moderate"}, "valueString", "moderate"),
    ],
)
def test_other_values(spark, given, name, value):
    body = json.loads(one(spark, **given).select(payloads.fhir_observation().alias("p")).first().p)
    assert body[name] == value
    assert [k for k in body if k.startswith("value")] == [name]
    assert "encounter" not in body


def test_empty_encounter_is_left_out(spark):
    df = one(spark, value=1.0, encounter_id="")
    body = json.loads(df.select(payloads.fhir_observation().alias("p")).first().p)
    assert "encounter" not in body


def test_flowsheet(spark):
    df = one(spark, value_bool=True, metadata_json='{"flowsheet_template_id":"T1"}')
    body = json.loads(df.select(payloads.flowsheet_value().alias("p")).first().p)
    assert body == {
        "PatientID": "P100",
        "PatientIDType": "FHIR",
        "ContactID": "",
        "ContactIDType": "CSN",
        "FlowsheetRowID": "59408-5",
        "FlowsheetRowIDType": "EXTERNAL",
        "Value": "True",
        "InstantValueTaken": "2025-06-15T10:30:00Z",
        "FlowsheetTemplateID": "T1",
    }


def test_defaults_replace_empty_text(spark):
    queue = spark.createDataFrame(
        [("P", None, "c", "", "", 1.0, None, None, None, AT, "", None)], QUEUE
    )
    row = to_observations(queue, default_source="me").first()
    assert (row.code_system, row.display_name, row.source_system) == ("http://loinc.org", "c", "me")
    assert row.metadata_json == "{}" and row.unit is None


@pytest.mark.parametrize(
    "given",
    [
        {"value": 42.0},
        {"value_str": "42"},
        {"value_bool": True},
        {"value": 1.5e12, "unit": "u"},
        {"value_str": 'quote " and é', "encounter_id": "E", "metadata_json": '{"a":{"b":[1,2]}}'},
    ],
)
def test_observation_json_round_trip(spark, given):
    df = one(spark, **given)
    back = df.select(values.restore_observation(values.observation_json()).alias("o"))
    assert back.select("o.*").first() == df.first()


@pytest.mark.parametrize("broken", ["{bad", "", "[]", '{"patient_id":"P"}', "null"])
def test_broken_json_is_null(spark, broken):
    df = spark.createDataFrame([(broken,)], "j STRING")
    assert df.select(values.restore_observation(F.col("j")).alias("o")).first().o is None


def test_backoff(spark):
    attempts = spark.createDataFrame([(n,) for n in (0, 1, 2, 3, 10)], "n INT")
    got = attempts.select(retry.backoff_seconds(F.col("n"), Retries()).alias("s")).collect()
    assert [r.s for r in got] == [1.0, 2.0, 4.0, 8.0, 30.0]
    assert Retries(times=6).schedule() == [1.0, 2.0, 4.0, 8.0, 16.0, 30.0]


MEASURED = (
    "temperature_c DOUBLE, heart_rate INT, respiratory_rate INT, systolic_bp INT, "
    "wbc_count DOUBLE, lactate DOUBLE"
)
NORMAL = {
    "temperature_c": 37.0,
    "heart_rate": 80,
    "respiratory_rate": 16,
    "systolic_bp": 120,
    "wbc_count": 7.0,
    "lactate": 1.0,
}


@pytest.mark.parametrize(
    "name,value,sirs,qsofa",
    [
        ("temperature_c", 38.0, 0, 0),
        ("temperature_c", 38.1, 1, 0),
        ("temperature_c", 36.0, 0, 0),
        ("temperature_c", 35.9, 1, 0),
        ("heart_rate", 90, 0, 0),
        ("heart_rate", 91, 1, 0),
        ("respiratory_rate", 20, 0, 0),
        ("respiratory_rate", 21, 1, 0),
        ("respiratory_rate", 22, 1, 1),
        ("systolic_bp", 101, 0, 0),
        ("systolic_bp", 100, 0, 1),
        ("wbc_count", 12.0, 0, 0),
        ("wbc_count", 12.1, 1, 0),
        ("wbc_count", 4.0, 0, 0),
        ("wbc_count", 3.9, 1, 0),
    ],
)
def test_scoring_boundaries(spark, name, value, sirs, qsofa):
    df = spark.createDataFrame([tuple({**NORMAL, name: value}.values())], MEASURED)
    row = df.select(
        scoring.sirs_score().alias("s"),
        scoring.qsofa_score().alias("q"),
        scoring.sirs_criteria().alias("sc"),
        scoring.qsofa_criteria().alias("qc"),
    ).first()
    assert (row.s, row.q) == (sirs, qsofa)
    assert (len(row.sc), len(row.qc)) == (sirs, qsofa)


@pytest.mark.parametrize(
    "sirs,qsofa,lactate,level",
    [
        (3, 0, 4.0, "critical"),
        (2, 0, 4.0, "high"),
        (2, 2, 0.5, "high"),
        (2, 1, 1.9, "moderate"),
        (0, 1, 0.5, "moderate"),
        (0, 0, 2.0, "moderate"),
        (1, 0, 1.9, "low"),
    ],
)
def test_risk_levels(spark, sirs, qsofa, lactate, level):
    row = spark.range(1).select(
        scoring.risk_level(F.lit(sirs), F.lit(qsofa), F.lit(lactate)).alias("level")
    )
    assert row.first().level == level


def test_key_matches_hashlib(spark):
    raw = f"P1:c:{AT.isoformat()}"
    df = spark.createDataFrame([("P1", "c", AT)], "p STRING, c STRING, t TIMESTAMP")
    key = df.select(idempotency_key(F.col("p"), F.col("c"), F.col("t")).alias("k")).first().k
    assert key == hashlib.sha256(raw.encode()).hexdigest()


def test_nan_never_scores(spark):
    from chartpost.operators.cohort import score_cohort

    rows = [tuple({**NORMAL, "lactate": v}.values()) for v in (1.0, math.nan, None)]
    assert score_cohort(spark.createDataFrame(rows, MEASURED)).count() == 1
