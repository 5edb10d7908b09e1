"""Endpoint routes: how each (system, API) pair is addressed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FHIR_JSON = "application/fhir+json"
PLAIN_JSON = "application/json"


@dataclass(frozen=True)
class Route:
    ehr_system: str
    api: str
    key_prefix: str
    path: str
    content_type: str
    accept: str | None
    payload_kind: str
    returns_id: bool


# The four supported routes.
ROUTES = (
    Route("generic_fhir", "fhir", "fhir:", "/Observation", FHIR_JSON, FHIR_JSON, "fhir", True),
    Route("epic", "fhir", "", "/Observation", FHIR_JSON, None, "fhir", True),
    Route("cerner", "fhir", "cerner:", "/Observation", FHIR_JSON, FHIR_JSON, "fhir", True),
    Route(
        "epic",
        "flowsheet",
        "fs:",
        "/api/epic/2014/Clinical/Patient/ADDFLOWSHEETVALUE/FlowsheetValue",
        PLAIN_JSON,
        None,
        "flowsheet",
        False,
    ),
)


def routes(spark: SparkSession, listed: tuple[Route, ...] = ROUTES) -> DataFrame:
    """The route list as a literal table (its size is the length of the list)."""
    rows = F.explode(
        F.array(
            *[
                F.struct(*[F.lit(value).alias(name) for name, value in vars(route).items()])
                for route in listed
            ]
        )
    )
    return spark.range(1, numPartitions=1).select(rows.alias("route")).select("route.*")


def check_route(ehr_system: str, api: str, listed: tuple[Route, ...] = ROUTES) -> None:
    """Refuse a pair that is not listed, before anything is read or sent."""
    if not any((route.ehr_system, route.api) == (ehr_system, api) for route in listed):
        known = ", ".join(f"{route.ehr_system}/{route.api}" for route in listed)
        raise ValueError(f"no route {ehr_system}/{api}; known: {known}")


def with_route(df: DataFrame, listed: tuple[Route, ...] = ROUTES) -> DataFrame:
    """Resolve (ehr_system, api); a row of an unknown route keeps null route columns.

    The broadcast side is the literal list above, so its size does not depend on data.
    """
    return df.join(F.broadcast(routes(df.sparkSession, listed)), ["ehr_system", "api"], "left")
