"""Patients at the endpoint: who is missing, and source id -> endpoint id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartpost.functions.payloads import create_criterion, fhir_patient
from chartpost.functions.retry import error_text
from chartpost.operators.outcomes import CIRCUIT_OPEN
from chartpost.schemas import FAILED
from chartpost.sources.routes import FHIR_JSON

IDENTIFIER_SYSTEM = "urn:chartpost:patient"
PATIENT_PATH = "/Patient"
# What a conditional create found out: made now, or there before.
CREATED, KNOWN = "created", "known"


def patients_to_create(
    patients: DataFrame, registered: DataFrame, identifier_system: str = IDENTIFIER_SYSTEM
) -> DataFrame:
    """Conditional-create requests for ids the map does not hold yet, one row per id."""
    wanted = patients.where(F.col("patient_id").isNotNull()).groupBy("patient_id").agg(F.min("name").alias("name"))
    missing = wanted.join(registered.select("patient_id"), "patient_id", "left_anti")
    return missing.select(
        "patient_id",
        "name",
        fhir_patient(F.col("patient_id"), F.col("name"), identifier_system).alias("request_body"),
        create_criterion(F.col("patient_id"), identifier_system).alias("if_none_exist"),
    )


def create_requests(planned: DataFrame, base_url: str) -> DataFrame:
    """Request envelope of each row of ``patients_to_create``, with its key in ``idempotency_key``.

    The criterion makes the endpoint look before it creates, so a request that is
    sent again creates nobody twice.
    """
    headers = F.create_map(
        F.lit("Content-Type"), F.lit(FHIR_JSON), F.lit("Accept"), F.lit(FHIR_JSON),
        F.lit("If-None-Exist"), F.col("if_none_exist"),
    )
    return planned.withColumns(
        {
            "url": F.lit(base_url + PATIENT_PATH),
            "headers": headers,
            "request_id": F.col("idempotency_key"),
            "returns_id": F.lit(True),
            "effective_date": F.lit(None).cast("date"),
        }
    )


def create_outcomes(attempts: DataFrame) -> DataFrame:
    """One row per request from its attempts: the endpoint's id, or the last error.

    An accepted answer without an id is a failure, as nothing could be sent for it.
    """
    found = F.get_json_object("body", "$.id")
    won = F.col("ok") & found.isNotNull()
    message = F.when(F.col("gated"), F.lit(CIRCUIT_OPEN)).otherwise(
        error_text(F.col("http_status"), F.col("body"), F.col("transport_error"))
    )
    head = ["attempt", "attempted_at", "seq"]
    folded = attempts.groupBy("idempotency_key").agg(
        F.min(F.when(won, F.struct(*head, "http_status", found.alias("id")))).alias("_won"),
        F.max(F.when(~won, F.struct(*head, message.alias("message")))).alias("_lost"),
    )
    succeeded = F.col("_won").isNotNull()
    made = F.when(F.col("_won.http_status") == 201, F.lit(CREATED)).otherwise(F.lit(KNOWN))
    return folded.select(
        "idempotency_key",
        F.col("_won.id").alias("endpoint_patient_id"),
        F.when(succeeded, made).otherwise(F.lit(FAILED)).alias("status"),
        F.when(~succeeded, F.col("_lost.message")).alias("error_message"),
        F.coalesce("_won.attempted_at", "_lost.attempted_at").alias("attempted_at"),
    )


def known_patients(links: DataFrame, endpoint: str) -> DataFrame:
    """(patient_id, endpoint_patient_id) of every answer of the endpoint that held an id."""
    return links.where(
        (F.col("endpoint") == endpoint) & F.col("endpoint_patient_id").isNotNull()
    ).select("patient_id", "endpoint_patient_id")


def fold_patient_map(patient_map: DataFrame) -> DataFrame:
    """One row per patient: the endpoint's id, or ``ambiguous`` where the map holds several.

    A row sent for an ambiguous patient could land on somebody else, so no id is chosen.
    """
    folded = (
        patient_map.where(F.col("endpoint_patient_id").isNotNull())
        .groupBy("patient_id")
        .agg(F.min("endpoint_patient_id").alias("_low"), F.max("endpoint_patient_id").alias("_high"))
    )
    single = F.col("_low") == F.col("_high")
    return folded.select(
        "patient_id", F.when(single, F.col("_low")).alias("endpoint_patient_id"), (~single).alias("ambiguous")
    )


def map_patients(rows: DataFrame, patient_map: DataFrame) -> DataFrame:
    """Replace the source patient id by the endpoint's; rows without exactly one are left out."""
    known = fold_patient_map(patient_map).where(~F.col("ambiguous")).drop("ambiguous")
    found = rows.join(known, "patient_id")
    return found.withColumn("patient_id", F.col("endpoint_patient_id")).drop(
        "endpoint_patient_id"
    )


def mark_unmapped(rows: DataFrame, patient_map: DataFrame) -> DataFrame:
    """All rows, each once, with the endpoint's patient id in ``endpoint_patient_id``.

    It is null for a patient whom the map does not hold, and for an ``ambiguous`` one.
    """
    joined = rows.join(fold_patient_map(patient_map), "patient_id", "left")
    return joined.withColumn("ambiguous", F.coalesce("ambiguous", F.lit(False)))


def unmapped_patients(rows: DataFrame, patient_map: DataFrame) -> DataFrame:
    """Ids without a map entry and how many rows they hold back."""
    counted = rows.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n_rows"))
    known = patient_map.where(F.col("endpoint_patient_id").isNotNull()).select("patient_id")
    return counted.join(known, "patient_id", "left_anti")


def pairing_report(patients: DataFrame, scores: DataFrame) -> DataFrame:
    """Strict pairing check: ids and row counts must agree on both sides.

    Each side is first folded to one row per id.
    """
    left = patients.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n_patients"))
    right = scores.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n_scores"))
    both = left.join(right, "patient_id", "full_outer")
    n_left = F.coalesce("n_patients", F.lit(0))
    n_right = F.coalesce("n_scores", F.lit(0))
    return both.agg(
        F.count_if(n_left == n_right).alias("paired"),
        F.count_if(n_right == 0).alias("without_score"),
        F.count_if(n_left == 0).alias("without_patient"),
        F.count_if((n_left > 0) & (n_right > 0) & (n_left != n_right)).alias("count_mismatch"),
    )
