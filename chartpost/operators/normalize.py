"""Queue rows -> ready rows -> normalised observations with keys and payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartpost.functions.keys import idempotency_key
from chartpost.functions.payloads import fhir_observation, flowsheet_value
from chartpost.functions.text import non_empty
from chartpost.functions.values import value_type
from chartpost.operators.expectations import keep_valid, queue_rules
from chartpost.schemas import DEFAULT_SOURCE, LOINC, READY
from chartpost.sources.routes import ROUTES, Route, with_route


def ready_rows(queue: DataFrame, queued_at: Column | None = None) -> DataFrame:
    """Valid queue rows in ready-table column order, stamped with the processing time."""
    stamp = F.current_timestamp() if queued_at is None else queued_at
    return (
        keep_valid(queue, queue_rules())
        .withColumn("queued_at", stamp)
        .select(*[name for name in READY.fieldNames() if name != "queued_date"])
    )


def to_observations(rows: DataFrame, default_source: str = DEFAULT_SOURCE) -> DataFrame:
    """Normalised observations; null and empty text both take the default.

    A numeric ``value`` is enough; ``value_str``, ``value_bool`` and
    ``metadata_json`` are used where the source has them.
    """

    def optional(name: str, kind: str) -> Column:
        return F.col(name) if name in rows.columns else F.lit(None).cast(kind)

    # Columns this step does not know (queue time, routing) pass through.
    known = {"observation_code", "value"}
    built = {
        "patient_id": F.col("patient_id"),
        "encounter_id": F.col("encounter_id"),
        "code": F.col("observation_code"),
        "code_system": F.coalesce(non_empty(F.col("code_system")), F.lit(LOINC)),
        "display_name": F.coalesce(
            non_empty(F.col("display_name")), F.col("observation_code")
        ),
        "value_type": value_type(
            optional("value_bool", "boolean"), F.col("value"), optional("value_str", "string")
        ),
        "value_num": F.col("value"),
        "value_str": optional("value_str", "string"),
        "value_bool": optional("value_bool", "boolean"),
        "unit": F.col("unit"),
        "effective_datetime": F.col("effective_datetime"),
        "source_system": F.coalesce(non_empty(F.col("source_system")), F.lit(default_source)),
        "metadata_json": F.coalesce(
            non_empty(optional("metadata_json", "string")), F.lit("{}")
        ),
    }
    passed = [c for c in rows.columns if c not in built and c not in known]
    out = rows.select(*[c.alias(name) for name, c in built.items()], *passed)
    # Exactly one of the three value columns stays set.
    kind = F.col("value_type")
    return out.withColumns(
        {
            "value_num": F.when(kind == "number", F.col("value_num")),
            "value_str": F.when(kind == "string", F.col("value_str")),
            "value_bool": F.when(kind == "boolean", F.col("value_bool")),
        }
    )


def with_key(observations: DataFrame) -> DataFrame:
    """Add the ledger key and the date the ledger is partitioned by.

    The instant is part of the key, so equal keys always share that date.
    """
    effective = F.col("effective_datetime")
    return observations.withColumns(
        {
            "idempotency_key": idempotency_key(F.col("patient_id"), F.col("code"), effective),
            "effective_date": F.to_date(effective),
        }
    )


def with_request(
    observations: DataFrame, base_url: str | Column, listed: tuple[Route, ...] = ROUTES
) -> DataFrame:
    """Request envelope per row: url, headers, body and the route-prefixed request id.

    The token never becomes a column; the sender adds it on the executor.
    """
    base = F.lit(base_url) if isinstance(base_url, str) else base_url
    routed = with_route(observations, listed)
    headers = F.map_filter(
        F.create_map(
            F.lit("Content-Type"),
            F.col("content_type"),
            F.lit("Accept"),
            F.col("accept"),
        ),
        lambda _, value: value.isNotNull(),
    )
    return routed.withColumns(
        {
            "url": F.concat(base, F.col("path")),
            "headers": headers,
            "request_id": idempotency_key(
                F.col("patient_id"),
                F.col("code"),
                F.col("effective_datetime"),
                F.col("key_prefix"),
            ),
            "request_body": F.when(
                F.col("payload_kind") == "flowsheet", flowsheet_value()
            ).otherwise(fhir_observation()),
        }
    )
