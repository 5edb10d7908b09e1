"""Stored FHIR Observations read back and compared with what was sent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartpost.operators.skew import plain_side

RESOURCE_SCHEMA = """
    resourceType STRING, id STRING, status STRING,
    code STRUCT<coding: ARRAY<STRUCT<system: STRING, code: STRING, display: STRING>>, text: STRING>,
    subject STRUCT<reference: STRING>, encounter STRUCT<reference: STRING>,
    effectiveDateTime STRING, valueQuantity STRUCT<value: DOUBLE, unit: STRING, system: STRING>,
    valueString STRING, valueBoolean BOOLEAN
"""

COMPARED = ("code_system", "code", "value_num", "value_str", "value_bool", "unit", "patient_id")


def flatten_resources(stored: DataFrame, column: str = "resource_json") -> DataFrame:
    """One flat row per resource."""
    kept = [c for c in stored.columns if c != column]
    resource = F.from_json(F.col(column), RESOURCE_SCHEMA)
    coding = F.get(F.col("_r.code.coding"), F.lit(0))

    def last_part(reference: str):
        return F.regexp_extract(F.col(reference), r"([^/]+)$", 1)

    return stored.select(*kept, resource.alias("_r")).select(
        *kept,
        F.col("_r.resourceType").alias("resource_type"),
        F.col("_r.status").alias("status"),
        coding["system"].alias("code_system"),
        coding["code"].alias("code"),
        coding["display"].alias("display_name"),
        last_part("_r.subject.reference").alias("patient_id"),
        last_part("_r.encounter.reference").alias("encounter_id"),
        F.col("_r.effectiveDateTime").alias("effective_text"),
        F.col("_r.valueQuantity.value").alias("value_num"),
        F.col("_r.valueQuantity.unit").alias("unit"),
        F.col("_r.valueString").alias("value_str"),
        F.col("_r.valueBoolean").alias("value_bool"),
    )


def reconcile(sent: DataFrame, stored: DataFrame) -> DataFrame:
    """Sent against stored by resource id, with the fields that differ.

    Rows without an id match nothing; they skip the join instead of all meeting in
    the one partition nulls hash to.  The full outer join is written as a left join
    and an anti join against the folded ids, because adaptive execution can split a
    repeated id in those two only.  Each side feeds three branches, so its id and
    compared fields are stored once, and no payload is built or parsed again.
    """
    id_name = "ehr_resource_id"

    def side(df: DataFrame, name: str) -> DataFrame:
        return plain_side(df.select(id_name, F.struct(*COMPARED).alias(name)))

    left, right = side(sent, "sent"), side(stored, "stored")
    has_id = F.col(id_name).isNotNull()
    known = right.where(has_id)
    joined = left.where(has_id).join(known, id_name, "left")
    sent_ids = left.where(has_id).select(id_name).distinct()
    rows = (
        joined.unionByName(left.where(~has_id), allowMissingColumns=True)
        .unionByName(known.join(sent_ids, id_name, "left_anti"), allowMissingColumns=True)
        .unionByName(right.where(~has_id), allowMissingColumns=True)
    )
    differing = F.array_compact(
        F.array(
            *[
                F.when(~F.col(f"sent.{c}").eqNullSafe(F.col(f"stored.{c}")), F.lit(c))
                for c in COMPARED
            ]
        )
    )
    both = F.col("sent").isNotNull() & F.col("stored").isNotNull()
    return rows.select(
        id_name,
        F.when(F.col("stored").isNull(), F.lit("not_stored"))
        .when(F.col("sent").isNull(), F.lit("not_sent"))
        .when(F.size(differing) == 0, F.lit("equal"))
        .otherwise(F.lit("different"))
        .alias("verdict"),
        F.when(both, F.array_join(differing, ",")).otherwise(F.lit("")).alias("differing_fields"),
    )
