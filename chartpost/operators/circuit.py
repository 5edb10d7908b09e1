"""Circuit state per endpoint, derived from the attempt log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartpost.operators.skew import CHUNK, in_ordered_chunks
from chartpost.policies import Breaker
from chartpost.session import cut_lineage

ORDER = ["attempted_at", "seq"]


def _state(failures: Column, last_failure: Column, now: Column, policy: Breaker) -> Column:
    """closed below the threshold, else open until the recovery time has passed."""
    waited = F.unix_micros(now) - F.unix_micros(last_failure)
    recovery = F.lit(round(policy.rest_seconds * 1_000_000))
    return (
        F.when(failures < policy.limit, F.lit("closed"))
        .when(waited < recovery, F.lit("open"))
        .otherwise(F.lit("half_open"))
    )


def _sent(attempts: DataFrame) -> DataFrame:
    """Gated rows never reached the endpoint, so they do not count."""
    if "gated" in attempts.columns:
        attempts = attempts.where(~F.coalesce(F.col("gated"), F.lit(False)))
    return attempts.select("endpoint", *ORDER, "ok")


def circuit_tail(attempts: DataFrame) -> DataFrame:
    """Per endpoint: whether anything succeeded, and the failures after the last success.

    Two aggregations with map-side folding instead of a window, so a busy endpoint is
    never sorted in one task.
    """
    sent = _sent(attempts)
    position = F.struct(*ORDER)
    last_success = sent.groupBy("endpoint").agg(
        F.max(F.when(F.col("ok"), position)).alias("_last_ok")
    )
    after = (
        sent.where(~F.col("ok"))
        .join(last_success, "endpoint")
        .where(F.col("_last_ok").isNull() | (position > F.col("_last_ok")))
        .groupBy("endpoint")
        .agg(F.count(F.lit(1)).alias("failures"), F.max("attempted_at").alias("last_failure_at"))
    )
    return last_success.join(after, "endpoint", "left").select(
        "endpoint",
        F.col("_last_ok").isNotNull().alias("has_success"),
        F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures"),
        "last_failure_at",
    )


def with_state(
    counts: DataFrame, as_of: Column, policy: Breaker = Breaker()
) -> DataFrame:
    """Counts per endpoint with the state they mean at ``as_of``."""
    state = _state(F.col("failures"), F.col("last_failure_at"), as_of, policy)
    return counts.select("endpoint", "failures", "last_failure_at", state.alias("state"))


def circuit_state(
    attempts: DataFrame, as_of: Column, policy: Breaker = Breaker()
) -> DataFrame:
    """One row per endpoint of the log: failures since its last success, and its state."""
    return with_state(circuit_tail(attempts), as_of, policy)


def advance_circuit(previous: DataFrame, attempts: DataFrame) -> DataFrame:
    """Counts per endpoint after one more batch, without reading older attempts.

    A success in the batch resets what came before it; otherwise failures add up.
    """
    tail = circuit_tail(attempts).select(
        "endpoint",
        "has_success",
        F.col("failures").alias("_new"),
        F.col("last_failure_at").alias("_new_at"),
    )
    reset = F.coalesce("has_success", F.lit(False))
    earlier = F.when(reset, F.lit(0)).otherwise(F.coalesce("failures", F.lit(0)))
    return previous.join(tail, "endpoint", "full_outer").select(
        "endpoint",
        (earlier + F.coalesce("_new", F.lit(0))).cast("bigint").alias("failures"),
        F.coalesce("_new_at", F.when(~reset, F.col("last_failure_at"))).alias("last_failure_at"),
    )


def latest_counts(snapshots: DataFrame) -> DataFrame:
    """Newest snapshot per endpoint."""
    newest = snapshots.groupBy("endpoint").agg(
        F.max(F.struct("taken_at", "failures", "last_failure_at")).alias("_newest")
    )
    return newest.select("endpoint", "_newest.failures", "_newest.last_failure_at")


def circuit_history(
    attempts: DataFrame, policy: Breaker = Breaker(), chunks: int | None = None
) -> DataFrame:
    """State in force just before every attempt.

    Within a chunk the counts come from one window; a failure count since the last
    success is the running failure count minus its value at that success.  What
    earlier chunks of the endpoint contribute is one row per (endpoint, chunk).
    """
    ranged = in_ordered_chunks(_sent(attempts), ["endpoint"], ORDER, chunks)
    upto = Window.partitionBy(CHUNK, "endpoint").orderBy(*ORDER)
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    failed = ~F.col("ok")
    running = F.count_if(failed).over(
        upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = (
        ranged.withColumn("_running", running)
        .withColumns(
            {
                "_fails": F.coalesce(F.count_if(failed).over(before), F.lit(0)),
                "_at_ok": F.max(F.when(F.col("ok"), F.col("_running"))).over(before),
                "_last_fail": F.max(F.when(failed, F.col("attempted_at"))).over(before),
            }
        )
    )
    local = cut_lineage(local)

    summary = local.groupBy("endpoint", CHUNK).agg(
        F.count_if(failed).alias("_n"),
        F.max(F.when(F.col("ok"), F.col("_running"))).alias("_n_at_ok"),
        F.max(F.when(failed, F.col("attempted_at"))).alias("_chunk_fail"),
    )
    # At most one row per chunk and endpoint: bounded by chunks, not by events.
    chunks_before = (
        Window.partitionBy("endpoint").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )
    total = F.coalesce(F.sum("_n").over(chunks_before), F.lit(0))
    carried = (
        summary.withColumn("_total", total)
        .withColumn(
            "_total_at_ok",
            F.max(
                F.when(F.col("_n_at_ok").isNotNull(), F.col("_total") + F.col("_n_at_ok"))
            ).over(chunks_before),
        )
        .select(
            "endpoint",
            CHUNK,
            (F.col("_total") - F.coalesce("_total_at_ok", F.lit(0))).alias("_carry"),
            F.max("_chunk_fail").over(chunks_before).alias("_carry_fail"),
        )
    )
    joined = local.join(carried, ["endpoint", CHUNK])
    failures = F.when(
        F.col("_at_ok").isNotNull(), F.col("_fails") - F.col("_at_ok")
    ).otherwise(F.col("_fails") + F.col("_carry"))
    last_failure = F.when(failures > 0, F.coalesce("_last_fail", "_carry_fail"))
    return joined.select(
        "endpoint",
        *ORDER,
        "ok",
        failures.alias("failures_before"),
        last_failure.alias("last_failure_before"),
        _state(failures, last_failure, F.col("attempted_at"), policy).alias("state_before"),
    )
