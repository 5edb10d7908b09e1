"""Delivery ledger: an append-only event table read through its current view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartpost.operators.skew import CHUNK, in_ordered_chunks
from chartpost.schemas import DELIVERY_KEY, LEDGER, SUCCESS
from chartpost.session import cut_lineage


def current_ledger(events: DataFrame) -> DataFrame:
    """Latest event per delivery key: what an upsert by key would have left.

    Spark limits each key to one row before the shuffle (window group limit), so
    a key with many events costs each map task one row.
    """
    latest = Window.partitionBy(*DELIVERY_KEY).orderBy(
        F.col("attempted_at").desc(), F.col("seq").desc()
    )
    return (
        events.withColumn("_rank", F.row_number().over(latest))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def success_keys(events: DataFrame) -> DataFrame:
    """Keys whose current status is success."""
    thin = events.select(*DELIVERY_KEY, "status", "attempted_at", "seq")
    return current_ledger(thin).where(F.col("status") == SUCCESS).select(*DELIVERY_KEY)


def delivered_keys(events: DataFrame, batch_keys: DataFrame) -> DataFrame:
    """Success keys among those of a batch.

    The ledger is reduced to the batch's keys before its latest event is picked; adaptive
    execution broadcasts a small batch and shuffles a large one.
    """
    keys = batch_keys.select(*DELIVERY_KEY).distinct()
    return success_keys(events.join(keys, list(DELIVERY_KEY), "left_semi"))


def prune_dates(events: DataFrame, batch: DataFrame) -> DataFrame:
    """Keep the ledger partitions of the batch's effective dates.

    Exact, because equal keys have equal dates.  The join on the partition column lets
    Spark skip the folders of all other dates, however many dates there are.  Dates are
    taken from the instant, so no key is hashed for them.
    """
    has_instant = "effective_datetime" in batch.columns
    date = F.to_date("effective_datetime") if has_instant else F.col("effective_date")
    dates = batch.select(date.alias("effective_date")).distinct()
    return events.join(dates, "effective_date", "left_semi")


def ledger_rows(outcomes: DataFrame) -> DataFrame:
    """Outcomes (success and dead-lettered alike) as ledger events."""
    return outcomes.select(
        "idempotency_key",
        "patient_id",
        F.col("code").alias("observation_code"),
        "ehr_system",
        "api",
        "ehr_resource_id",
        "status",
        "attempted_at",
        "error_message",
        "retry_count",
        "seq",
        "batch_id",
        "effective_date",
    )


def change_feed(events: DataFrame, chunks: int | None = None) -> DataFrame:
    """Insert / update_preimage / update_postimage rows of the ledger events.

    The previous event of a key comes from the same chunk, or, for the first row of
    a chunk, from the last row of the chunk before it (one row per chunk).
    """
    order = ["attempted_at", "seq"]
    names = [n for n in LEDGER.fieldNames() if n in events.columns]
    image = F.struct(*names)
    local = Window.partitionBy(CHUNK, *DELIVERY_KEY).orderBy(*order)
    ranged = in_ordered_chunks(events.select(*names), DELIVERY_KEY, order, chunks)
    rows = cut_lineage(ranged.withColumn("_before", F.lag(image).over(local)))

    lasts = rows.groupBy(CHUNK).agg(
        F.max_by(image, F.struct(*DELIVERY_KEY, *order)).alias("_last")
    )
    # One row per range, at most as many as there are shuffle partitions.
    following = Window.orderBy(CHUNK)
    carried = lasts.select(CHUNK, F.lag("_last").over(following).alias("_carried"))

    same_key: Column = F.lit(True)
    for name in DELIVERY_KEY:
        same_key = same_key & F.col(name).eqNullSafe(F.col(f"_carried.{name}"))
    joined = rows.join(F.broadcast(carried), CHUNK).withColumn(
        "_before", F.coalesce("_before", F.when(same_key, F.col("_carried")))
    )

    def change(kind: str, row: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("change_type"),
            F.col("attempted_at").alias("changed_at"),
            *[row[n].alias(n) for n in names],
        )

    changes = F.when(F.col("_before").isNull(), F.array(change("insert", image))).otherwise(
        F.array(
            change("update_preimage", F.col("_before")), change("update_postimage", image)
        )
    )
    return joined.select(F.explode(changes).alias("change")).select("change.*")
