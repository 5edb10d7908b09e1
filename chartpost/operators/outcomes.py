"""From attempts to outcomes: first success wins, otherwise the last error is kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartpost.functions.retry import (
    attempt_ok,
    backoff_seconds,
    error_text,
    plus_seconds,
    resource_id,
)
from chartpost.operators.dedup import GATED
from chartpost.policies import Retries
from chartpost.schemas import DEAD_LETTERED, DELIVERY_KEY, FAILED, SUCCESS
from chartpost.sources.routes import ROUTES, Route, with_route

CIRCUIT_OPEN = "Circuit breaker open"


def classify_responses(responses: DataFrame, listed: tuple[Route, ...] = ROUTES) -> DataFrame:
    """Status, resource id and error text of every response.

    A logged ``ok`` is what the sender acted on, so it is kept where there is one.
    """
    routed = with_route(responses, listed)
    body, status = F.col("body"), F.col("http_status")
    transport_error, returns_id = F.col("transport_error"), F.col("returns_id")
    if "ok" in responses.columns:
        ok = F.col("ok")
    else:
        ok = transport_error.isNull() & attempt_ok(status, body, returns_id)
    message = error_text(status, body, transport_error)
    if "gated" in responses.columns:
        message = F.when(F.col("gated"), F.lit(CIRCUIT_OPEN)).otherwise(message)
    return routed.select(
        *responses.columns,
        F.when(ok, F.lit(SUCCESS)).otherwise(F.lit(FAILED)).alias("status"),
        F.when(ok, resource_id(body, returns_id)).alias("ehr_resource_id"),
        F.when(~ok, message).alias("error_message"),
    )


def resolve_attempts(attempts: DataFrame, max_retries: int) -> DataFrame:
    """One row per delivery key from classified attempts.

    Both candidates are structs led by the attempt number, so one aggregation with
    map-side folding finds the first success and the last failure.
    """
    won = F.col("status") == SUCCESS
    sent = ~F.coalesce(F.col("gated"), F.lit(False))
    head = ["attempt", "attempted_at", "seq"]
    folded = attempts.groupBy(*DELIVERY_KEY).agg(
        F.min(F.when(won, F.struct(*head, "ehr_resource_id"))).alias("_won"),
        F.max(F.when(~won, F.struct(*head, "error_message", "gated"))).alias("_lost"),
        F.count_if(sent).cast("int").alias("attempts_made"),
    )
    succeeded = F.col("_won").isNotNull()

    def either(field: str) -> Column:
        return F.when(succeeded, F.col(f"_won.{field}")).otherwise(F.col(f"_lost.{field}"))

    return folded.select(
        *DELIVERY_KEY,
        F.when(succeeded, F.lit(SUCCESS)).otherwise(F.lit(DEAD_LETTERED)).alias("status"),
        F.col("_won.ehr_resource_id").alias("ehr_resource_id"),
        F.when(
            ~succeeded,
            F.coalesce(F.nullif(F.col("_lost.error_message"), F.lit("")), F.lit("Unknown error")),
        ).alias("error_message"),
        retry_count(succeeded, F.col("_won.attempt"), F.col("_lost.gated"), max_retries).alias(
            "retry_count"
        ),
        "attempts_made",
        either("attempted_at").alias("attempted_at"),
        either("seq").alias("seq"),
    )


def retry_count(succeeded: Column, attempt: Column, gated: Column, max_retries: int) -> Column:
    """Attempt number of the success; 0 when gated; else the allowed retries,
    also when the circuit ended them early (``attempts_made`` has the true count)."""
    return (
        F.when(succeeded, attempt)
        .when(F.coalesce(gated, F.lit(False)), F.lit(0))
        .otherwise(F.lit(max_retries))
    )


def gated_outcomes(plan: DataFrame) -> DataFrame:
    """Outcome columns of rows an open circuit kept from being sent."""
    return plan.where(F.col("outcome") == GATED).select(
        *DELIVERY_KEY,
        F.lit(DEAD_LETTERED).alias("status"),
        F.lit(None).cast("string").alias("ehr_resource_id"),
        F.lit(CIRCUIT_OPEN).alias("error_message"),
        F.lit(0).alias("retry_count"),
        F.lit(0).alias("attempts_made"),
        F.col("planned_at").alias("attempted_at"),
        F.lit(0).cast("bigint").alias("seq"),
    )


def dead_letter_outcomes(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("status") == DEAD_LETTERED)


def retry_schedule(first_failures: DataFrame, policy: Retries) -> DataFrame:
    """Every retry a failing key may still get, with its delay and due time.

    The policy is a driver-side constant, so the running sum is a literal per
    attempt and no shuffle is needed.
    """
    steps, total = [], 0.0
    for attempt, delay in enumerate(policy.schedule()):
        total += delay
        steps.append(
            F.struct(
                F.lit(attempt).alias("attempt"), F.lit(float(total)).alias("cumulative_seconds")
            )
        )
    return first_failures.select("*", F.inline(F.array(*steps))).select(
        *first_failures.columns,
        "attempt",
        backoff_seconds(F.col("attempt"), policy).alias("delay_seconds"),
        "cumulative_seconds",
        plus_seconds(F.col("attempted_at"), F.col("cumulative_seconds")).alias("next_attempt_at"),
    )
