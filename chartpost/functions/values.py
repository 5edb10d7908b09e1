"""The observation value (boolean, number or text) and the stored observation JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartpost.functions.text import iso_instant, python_float_text
from chartpost.schemas import OBSERVATION

BOOLEAN = "boolean"
NUMBER = "number"
STRING = "string"


def value_type(value_bool: Column, value_num: Column, value_str: Column) -> Column:
    """Which of the three columns carries the value; boolean before number before text."""
    return (
        F.when(value_bool.isNotNull(), F.lit(BOOLEAN))
        .when(value_num.isNotNull(), F.lit(NUMBER))
        .when(value_str.isNotNull(), F.lit(STRING))
    )


def value_text(kind: Column, value_bool: Column, value_num: Column, value_str: Column) -> Column:
    """The value as Python's ``str`` prints it (``True``, ``42.0``, text unchanged)."""
    return (
        F.when(kind == BOOLEAN, F.when(value_bool, F.lit("True")).otherwise(F.lit("False")))
        .when(kind == NUMBER, python_float_text(value_num))
        .otherwise(value_str)
    )


def observation_json(obs=F.col) -> Column:
    """One normalised observation as JSON; ``value`` keeps its JSON type."""
    kind = obs("value_type")
    value = (
        F.when(kind == BOOLEAN, obs("value_bool").cast("variant"))
        .when(kind == NUMBER, obs("value_num").cast("variant"))
        .otherwise(obs("value_str").cast("variant"))
    )
    return F.to_json(
        F.struct(
            obs("patient_id").alias("patient_id"),
            obs("encounter_id").alias("encounter_id"),
            obs("code").alias("code"),
            obs("code_system").alias("code_system"),
            obs("display_name").alias("display_name"),
            value.alias("value"),
            obs("unit").alias("unit"),
            iso_instant(obs("effective_datetime"), "Z").alias("effective_datetime"),
            obs("source_system").alias("source_system"),
            F.try_parse_json(obs("metadata_json")).alias("metadata"),
        ),
        {"ignoreNullFields": "false"},
    )


def restore_observation(text: Column) -> Column:
    """Struct of the normalised observation, null when the text cannot be restored."""
    fields = F.from_json(
        text,
        """patient_id STRING, encounter_id STRING, code STRING, code_system STRING,
        display_name STRING, value VARIANT, unit STRING, effective_datetime STRING,
        source_system STRING, metadata VARIANT""",
    )
    stored = fields["value"]
    shape = F.schema_of_variant(stored)
    is_bool = shape == "BOOLEAN"
    is_text = shape == "STRING"
    is_number = (shape == "BIGINT") | (shape == "DOUBLE") | shape.startswith("DECIMAL")
    kind = F.when(is_bool, BOOLEAN).when(is_text, STRING).when(is_number, NUMBER)
    parts = {
        "value_type": kind,
        "value_num": F.when(is_number, F.try_variant_get(stored, "$", "double")),
        "value_str": F.when(is_text, F.try_variant_get(stored, "$", "string")),
        "value_bool": F.when(is_bool, F.try_variant_get(stored, "$", "boolean")),
        "effective_datetime": F.try_to_timestamp(fields["effective_datetime"]),
        "metadata_json": F.coalesce(F.to_json(fields["metadata"]), F.lit("{}")),
    }
    whole = F.struct(
        *[parts.get(name, fields[name]).alias(name) for name in OBSERVATION.fieldNames()]
    )
    complete = (
        fields["patient_id"].isNotNull()
        & fields["code"].isNotNull()
        & fields["display_name"].isNotNull()
        & kind.isNotNull()
        & parts["effective_datetime"].isNotNull()
    )
    return F.when(complete, whole)
