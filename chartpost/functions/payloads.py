"""Request bodies: FHIR Observation, flowsheet value, FHIR Patient."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartpost.functions.text import (
    family_name,
    given_name,
    iso_instant,
    non_empty,
    utc_seconds_instant,
)
from chartpost.functions.values import BOOLEAN, NUMBER, STRING, value_text
from chartpost.schemas import UCUM

# The observation category every payload carries.
CATEGORY_SYSTEM = "http://terminology.hl7.org/CodeSystem/observation-category"
CATEGORY_CODE = "survey"
CATEGORY_DISPLAY = "Survey"


def reference(kind: str, identifier: Column) -> Column:
    """``Patient/<id>``; null for a null or empty id."""
    return F.concat(F.lit(f"{kind}/"), non_empty(identifier))


def quantity(value: Column, unit: Column) -> Column:
    return F.struct(
        value.alias("value"),
        F.coalesce(unit, F.lit("")).alias("unit"),
        F.lit(UCUM).alias("system"),
    )


def fhir_observation(obs=F.col) -> Column:
    """FHIR R4 Observation as JSON; absent parts are left out."""
    category = F.array(
        F.struct(
            F.array(
                F.struct(
                    F.lit(CATEGORY_SYSTEM).alias("system"),
                    F.lit(CATEGORY_CODE).alias("code"),
                    F.lit(CATEGORY_DISPLAY).alias("display"),
                )
            ).alias("coding")
        )
    )
    code = F.struct(
        F.array(
            F.struct(
                obs("code_system").alias("system"),
                obs("code").alias("code"),
                obs("display_name").alias("display"),
            )
        ).alias("coding"),
        obs("display_name").alias("text"),
    )
    kind = obs("value_type")
    encounter = reference("Encounter", obs("encounter_id"))
    return F.to_json(
        F.struct(
            F.lit("Observation").alias("resourceType"),
            F.lit("final").alias("status"),
            category.alias("category"),
            code.alias("code"),
            # Unlike the encounter, an empty patient id still has a subject.
            F.struct(F.concat(F.lit("Patient/"), obs("patient_id")).alias("reference")).alias(
                "subject"
            ),
            iso_instant(obs("effective_datetime")).alias("effectiveDateTime"),
            F.when(encounter.isNotNull(), F.struct(encounter.alias("reference"))).alias(
                "encounter"
            ),
            F.when(kind == BOOLEAN, obs("value_bool")).alias("valueBoolean"),
            F.when(kind == NUMBER, quantity(obs("value_num"), obs("unit"))).alias("valueQuantity"),
            F.when(kind == STRING, obs("value_str")).alias("valueString"),
        )
    )


def metadata_text(metadata_json: Column, name: str, default: str = "") -> Column:
    """One metadata entry as text, ``default`` when it is missing."""
    return F.coalesce(F.get_json_object(metadata_json, f"$.{name}"), F.lit(default))


def flowsheet_value(obs=F.col) -> Column:
    """Flowsheet request as JSON; every field is text."""
    return F.to_json(
        F.struct(
            obs("patient_id").alias("PatientID"),
            F.lit("FHIR").alias("PatientIDType"),
            F.coalesce(obs("encounter_id"), F.lit("")).alias("ContactID"),
            F.lit("CSN").alias("ContactIDType"),
            obs("code").alias("FlowsheetRowID"),
            F.lit("EXTERNAL").alias("FlowsheetRowIDType"),
            value_text(
                obs("value_type"), obs("value_bool"), obs("value_num"), obs("value_str")
            ).alias("Value"),
            utc_seconds_instant(obs("effective_datetime")).alias("InstantValueTaken"),
            metadata_text(obs("metadata_json"), "flowsheet_template_id").alias(
                "FlowsheetTemplateID"
            ),
        )
    )


def fhir_patient(patient_id: Column, name: Column, identifier_system: str) -> Column:
    return F.to_json(
        F.struct(
            F.lit("Patient").alias("resourceType"),
            F.array(
                F.struct(family_name(name).alias("family"), F.array(given_name(name)).alias("given"))
            ).alias("name"),
            F.array(
                F.struct(F.lit(identifier_system).alias("system"), patient_id.alias("value"))
            ).alias("identifier"),
        )
    )


def create_criterion(patient_id: Column, identifier_system: str) -> Column:
    """Search that makes a create conditional: ``identifier=<system>|<id>``."""
    return F.concat(F.lit(f"identifier={identifier_system}|"), patient_id)
