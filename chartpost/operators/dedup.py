"""What a batch still has to send: folding duplicates, dropping what is delivered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartpost.operators.skew import first_rows, rank_in_group
from chartpost.schemas import DELIVERY_KEY

NEW = "new"
DELIVERED = "already_delivered"
DUPLICATE = "duplicate_in_batch"
GATED = "gated"


def _batch_order(columns: list[str]) -> list[str]:
    """Queue time, then source, then everything else: a total order of the rows' content."""
    first = [c for c in ("queued_at", "source_system") if c in columns]
    return first + [c for c in columns if c not in first and c not in DELIVERY_KEY]


def fold_batch(keyed: DataFrame) -> DataFrame:
    """One row per delivery key, the earliest, with the number of ``occurrences``.

    Map tasks fold first, so a key repeated through the whole batch reaches the
    shuffle once per task.
    """
    order = _batch_order(keyed.columns)
    folded = keyed.groupBy(*DELIVERY_KEY).agg(
        F.count(F.lit(1)).alias("occurrences"), F.min(F.struct(*order)).alias("_first")
    )
    return folded.select(*DELIVERY_KEY, "occurrences", *[F.col(f"_first.{c}") for c in order])


def flag_winners(keyed: DataFrame) -> DataFrame:
    """Row-level form of ``fold_batch``: every input row, with ``is_winner``."""
    order = [F.col(c) for c in _batch_order(keyed.columns)]
    return rank_in_group(keyed, DELIVERY_KEY, order, "is_winner")


def drop_delivered(batch: DataFrame, delivered: DataFrame) -> DataFrame:
    """Rows whose key is not delivered.

    For a batch that was not folded, where one key may fill the table, pass
    ``delivered`` through ``plain_side``.
    """
    return batch.join(delivered, list(DELIVERY_KEY), "left_anti")


def skipped_rows(keyed: DataFrame, delivered: DataFrame) -> DataFrame:
    """Keys of the batch that are already delivered, with how often each occurs."""
    counted = keyed.groupBy(*DELIVERY_KEY).agg(F.count(F.lit(1)).alias("occurrences"))
    return counted.join(delivered, list(DELIVERY_KEY), "left_semi")


def classify(folded: DataFrame, delivered: DataFrame) -> DataFrame:
    """Mark each folded key as ``new`` or ``already_delivered``.

    Both sides hold one row per key, so no key is hot in the join.
    """
    marked = delivered.select(*DELIVERY_KEY, F.lit(True).alias("_delivered"))
    return (
        folded.join(marked, list(DELIVERY_KEY), "left")
        .withColumn(
            "outcome",
            F.when(F.col("_delivered"), F.lit(DELIVERED)).otherwise(F.lit(NEW)),
        )
        .drop("_delivered")
    )


def gate(classified: DataFrame, circuit: DataFrame) -> DataFrame:
    """Turn new keys of an open endpoint into ``gated`` ones.

    ``circuit`` has one row per endpoint.  Adaptive execution broadcasts it, and splits
    the shuffle of a batch aimed at one endpoint where it does not.
    """
    states = circuit.select(
        "endpoint",
        F.col("state").alias("circuit_state"),
        F.col("failures").alias("circuit_failures"),
        F.col("last_failure_at").alias("circuit_last_failure_at"),
    )
    joined = classified.join(states, "endpoint", "left")
    is_gated = (F.col("outcome") == NEW) & (F.col("circuit_state") == "open")
    return joined.withColumns(
        {
            "outcome": F.when(F.coalesce(is_gated, F.lit(False)), F.lit(GATED)).otherwise(
                F.col("outcome")
            ),
            "circuit_state": F.coalesce("circuit_state", F.lit("closed")),
            "circuit_failures": F.coalesce("circuit_failures", F.lit(0).cast("bigint")),
        }
    )


def batch_partition(classified: DataFrame) -> DataFrame:
    """Input rows per (key, outcome): the first row carries the key's outcome, the
    rest of a new or gated key are duplicates; occurrences add up to the input rows."""
    delivered = F.col("outcome") == DELIVERED
    parts = F.array_compact(
        F.array(
            F.struct(
                F.col("outcome").alias("outcome"),
                F.when(delivered, F.col("occurrences"))
                .otherwise(F.lit(1).cast("bigint"))
                .alias("occurrences"),
            ),
            F.when(
                ~delivered & (F.col("occurrences") > 1),
                F.struct(
                    F.lit(DUPLICATE).alias("outcome"),
                    (F.col("occurrences") - 1).alias("occurrences"),
                ),
            ),
        )
    )
    return classified.select(*DELIVERY_KEY, F.inline(parts))


def next_rows(pending: DataFrame, limit: int | None) -> DataFrame:
    """The oldest ``limit`` rows, taken after everything delivered is gone."""
    if limit is None:
        return pending
    return first_rows(pending, ["queued_at", "effective_datetime", *DELIVERY_KEY], limit)
