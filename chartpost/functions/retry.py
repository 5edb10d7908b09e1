"""Backoff delays and the reading of one response."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartpost.policies import Retries


def backoff_seconds(attempt: Column, policy: Retries) -> Column:
    """Wait after the given attempt; the last wait of the list holds from there on."""
    waits = F.array(*map(F.lit, policy.waits))
    return F.element_at(waits, F.least(attempt.cast("int") + 1, F.lit(len(policy.waits))))


def plus_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + F.round(seconds * 1_000_000).cast("bigint"))


def is_2xx(http_status: Column) -> Column:
    return F.coalesce(http_status.between(200, 299), F.lit(False))


def readable_body(body: Column, returns_id: Column) -> Column:
    """A route that returns an id must answer with a JSON object."""
    return ~returns_id | F.json_object_keys(body).isNotNull()


def attempt_ok(http_status: Column, body: Column, returns_id: Column) -> Column:
    return is_2xx(http_status) & readable_body(body, returns_id)


def resource_id(body: Column, returns_id: Column) -> Column:
    return F.when(returns_id, F.get_json_object(body, "$.id"))


def error_text(http_status: Column, body: Column, transport_error: Column) -> Column:
    """Message of a failed attempt."""
    return (
        F.when(
            transport_error.isNotNull(), F.concat(F.lit("Connection error: "), transport_error)
        )
        .when(is_2xx(http_status), F.lit("Invalid response body"))
        .when(
            http_status.isNotNull(),
            F.concat(
                F.lit("HTTP "), http_status.cast("string"), F.lit(": "), F.coalesce(body, F.lit(""))
            ),
        )
        .otherwise(F.lit("Unknown error"))
    )
