"""Reports over outcomes, ledger and dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartpost.operators.dedup import DELIVERED
from chartpost.schemas import DEAD_LETTERED, DELIVERY_KEY, SUCCESS


def batch_summary(outcomes: DataFrame, planned: DataFrame) -> DataFrame:
    """Counts and success rate of one batch.

    ``planned`` has one row per key with its occurrences: all rows of a delivered key
    are skipped, and of any other key all but the first.  ``failed`` stays 0, as a row
    either succeeds or is dead-lettered; skipped rows count in the denominator.
    """
    skipped = F.when(F.col("outcome") == DELIVERED, F.col("occurrences")).otherwise(
        F.col("occurrences") - 1
    )
    zero = F.lit(0).cast("bigint")
    counted = outcomes.select(
        (F.col("status") == SUCCESS).cast("bigint").alias("succeeded"),
        zero.alias("skipped"),
        (F.col("status") == DEAD_LETTERED).cast("bigint").alias("dead_lettered"),
    ).unionByName(
        planned.select(
            zero.alias("succeeded"), skipped.alias("skipped"), zero.alias("dead_lettered")
        )
    )
    totals = counted.agg(
        *[
            F.coalesce(F.sum(name), zero).alias(name)
            for name in ("succeeded", "skipped", "dead_lettered")
        ]
    ).withColumn("failed", zero)
    total = F.col("succeeded") + F.col("skipped") + F.col("failed") + F.col("dead_lettered")
    return totals.withColumn("total", total).select(
        "succeeded",
        "skipped",
        "failed",
        "dead_lettered",
        "total",
        F.coalesce(F.try_divide("succeeded", "total"), F.lit(0.0)).alias("success_rate"),
    )


def duplicate_keys(log: DataFrame) -> DataFrame:
    """Deliveries (key, system, API) the log holds more than once."""
    return (
        log.groupBy(*DELIVERY_KEY)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def validation_summary(queue: DataFrame, log: DataFrame, letters: DataFrame) -> DataFrame:
    """Metric lines; the log is grouped once for rows, distinct and duplicate deliveries.

    One observation sent to two systems is two deliveries under one key, not a duplicate.
    """
    per_key = log.groupBy(*DELIVERY_KEY).agg(F.count(F.lit(1)).alias("n"))
    of_log = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("log_rows"),
        F.count(F.lit(1)).alias("distinct_idempotency_keys"),
        F.count_if(F.col("n") > 1).alias("duplicate_idempotency_keys"),
    )

    def line(metric: str, column):
        return F.struct(F.lit(metric).alias("metric"), column.alias("n"))

    log_lines = of_log.select(
        F.inline(F.array(*[line(name, F.col(name)) for name in of_log.columns]))
    )

    def size_line(metric: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(metric).alias("metric"), "n")

    return (
        size_line("queued_observations", queue)
        .unionByName(log_lines)
        .unionByName(size_line("dead_letter_rows", letters))
    )


def status_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("n_rows")).orderBy("status")


def latest(df: DataFrame, at: str, *tie_break: str, n: int = 20) -> DataFrame:
    """Newest ``n`` rows; ties fall to the key so that reruns agree."""
    return df.orderBy(F.col(at).desc(), *tie_break).limit(n)


def first_written(outcomes: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` written resources and one line for how many more there are."""
    won = outcomes.where(F.col("status") == SUCCESS)
    line = F.row_number().over(Window.orderBy("attempted_at", "seq")).cast("int")
    top = (
        won.orderBy("attempted_at", "seq")
        .limit(n)  # at most n rows reach the unpartitioned window
        .select(
            line.alias("line"),
            "ehr_resource_id",
            "display_name",
            F.lit(0).cast("bigint").alias("more"),
        )
    )
    rest = won.agg(F.greatest(F.count(F.lit(1)) - n, F.lit(0)).alias("more")).select(
        F.lit(n + 1).alias("line"),
        F.lit(None).cast("string").alias("ehr_resource_id"),
        F.lit(None).cast("string").alias("display_name"),
        "more",
    )
    return top.unionByName(rest.where(F.col("more") > 0))


def latest_of_code(observations: DataFrame, code: str, n: int = 20) -> DataFrame:
    """Newest observations of one code, ties in order of patient and value."""
    matching = observations.where(F.col("code") == code)
    ties = [c for c in ("patient_id", "value_str", "value_num", "encounter_id") if c in matching.columns]
    return latest(matching, "effective_datetime", *ties, n=n)
