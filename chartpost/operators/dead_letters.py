"""Dead letters: an append-only table of dead_lettered and reprocessed events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartpost.functions.values import observation_json, restore_observation
from chartpost.operators.skew import first_rows, plain_side
from chartpost.schemas import DEAD_LETTERED, DELIVERY_KEY, REPROCESSED


def dead_letter_rows(outcomes: DataFrame) -> DataFrame:
    """``dead_lettered`` events: flat columns plus the whole observation as JSON."""
    return outcomes.select(
        F.lit(DEAD_LETTERED).alias("event"),
        "idempotency_key",
        "patient_id",
        F.col("code").alias("observation_code"),
        "ehr_system",
        "api",
        observation_json().alias("observation_json"),
        F.col("error_message").alias("last_error"),
        "retry_count",
        "attempts_made",
        F.col("attempted_at").alias("event_at"),
        "seq",
        "batch_id",
        F.to_date("attempted_at").alias("event_date"),
    )


def reprocessed_rows(keys: DataFrame, event_at: Column, batch_id: str) -> DataFrame:
    """``reprocessed`` events; each covers all earlier letters of its key."""
    empty = F.lit(None)
    return keys.select(
        F.lit(REPROCESSED).alias("event"),
        "idempotency_key",
        empty.cast("string").alias("patient_id"),
        empty.cast("string").alias("observation_code"),
        "ehr_system",
        "api",
        empty.cast("string").alias("observation_json"),
        empty.cast("string").alias("last_error"),
        empty.cast("int").alias("retry_count"),
        empty.cast("int").alias("attempts_made"),
        event_at.alias("event_at"),
        F.lit(0).cast("bigint").alias("seq"),
        F.lit(batch_id).alias("batch_id"),
        F.to_date(event_at).alias("event_date"),
    )


def letter_states(events: DataFrame) -> DataFrame:
    """Every letter with its ``reprocessed`` flag, as an updated table would show it.

    The marks are folded to one row per key and stored, so the join sees two plain
    shuffles and adaptive execution can split a key with very many letters.
    """
    letters = events.where(F.col("event") == DEAD_LETTERED)
    marks = plain_side(
        events.where(F.col("event") == REPROCESSED)
        .groupBy(*DELIVERY_KEY)
        .agg(F.max("event_at").alias("_marked_at"))
    )
    return (
        letters.join(marks, list(DELIVERY_KEY), "left")
        .withColumn("reprocessed", F.coalesce(F.col("_marked_at") >= F.col("event_at"), F.lit(False)))
        .select(
            *DELIVERY_KEY,
            "patient_id",
            "observation_code",
            "observation_json",
            "last_error",
            "retry_count",
            F.col("event_at").alias("dead_lettered_at"),
            "reprocessed",
        )
    )


def pending_letters(events: DataFrame, limit: int | None = 100) -> DataFrame:
    """Keys with a letter newer than their last mark, oldest first.

    One aggregation over the events: latest letter and latest mark per key.  A key
    that fails again moves behind the others, so no key starves the rest.
    """
    letter = F.col("event") == DEAD_LETTERED
    body = [
        "event_at",
        "seq",
        "patient_id",
        "observation_code",
        "observation_json",
        "last_error",
        "retry_count",
    ]
    folded = events.groupBy(*DELIVERY_KEY).agg(
        F.max(F.when(letter, F.struct(*body))).alias("_letter"),
        F.max(F.when(F.col("event") == REPROCESSED, F.col("event_at"))).alias("_marked_at"),
    )
    sent_at = F.col("_letter.event_at")
    pending = folded.where(
        sent_at.isNotNull() & (F.col("_marked_at").isNull() | (sent_at > F.col("_marked_at")))
    ).select(
        *DELIVERY_KEY,
        *[F.col(f"_letter.{name}") for name in body[2:]],
        sent_at.alias("dead_lettered_at"),
    )
    if limit is None:
        return pending
    return first_rows(pending, ["dead_lettered_at", *DELIVERY_KEY], limit)


def rows_per_part(events: DataFrame) -> DataFrame:
    """Rows per partition of the letters.  No column is read, so the files' footers answer."""
    return events.groupBy(F.col("batch_id").alias("letter_batch"), "event").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def changed_batches(now: DataFrame, before: DataFrame) -> list[str]:
    """Batches whose letters or marks are not as many as they were: those since the last look."""
    known = before.select("letter_batch", "event", F.col("n_rows").alias("_rows"))
    joined = now.join(known, ["letter_batch", "event"], "left")
    fresh = joined.where(F.col("_rows").isNull() | (F.col("n_rows") != F.col("_rows")))
    return [row.letter_batch for row in fresh.select("letter_batch").distinct().collect()]


def pending_keys(earlier: DataFrame, fresh: DataFrame) -> DataFrame:
    """Pending keys after ``fresh`` events, given those pending before.

    One row per key: time and place of its latest letter, and whether that can be
    restored.  Only fresh letters are parsed, and none is carried along.  Reading an
    event again changes nothing.  A mark goes with its key, so a letter that comes to
    light later than a younger mark is pending again; the ledger then says delivered.
    """
    restored = restore_observation(F.col("observation_json"))
    place = ["dead_lettered_at", "seq", "letter_batch", "readable", "effective_datetime"]
    arrived = fresh.withColumn("_obs", restored).select(
        *DELIVERY_KEY,
        F.when(
            F.col("event") == DEAD_LETTERED,
            F.struct(
                F.col("event_at").alias("dead_lettered_at"),
                "seq",
                F.col("batch_id").alias("letter_batch"),
                F.col("_obs").isNotNull().alias("readable"),
                F.col("_obs.effective_datetime").alias("effective_datetime"),
            ),
        ).alias("_letter"),
        F.when(F.col("event") == REPROCESSED, F.col("event_at")).alias("_marked_at"),
    )
    known = earlier.select(
        *DELIVERY_KEY, F.struct(*place).alias("_letter"), F.lit(None).cast("timestamp").alias("_marked_at")
    )
    folded = (
        arrived.unionByName(known)
        .groupBy(*DELIVERY_KEY)
        .agg(F.max("_letter").alias("_letter"), F.max("_marked_at").alias("_marked_at"))
    )
    sent_at = F.col("_letter.dead_lettered_at")
    pending = sent_at.isNotNull() & (F.col("_marked_at").isNull() | (sent_at > F.col("_marked_at")))
    return folded.where(pending).select(*DELIVERY_KEY, *[F.col(f"_letter.{c}") for c in place])


def letters_of(events: DataFrame, keys: DataFrame) -> DataFrame:
    """The latest letters of ``keys`` (see ``pending_keys``), read from their batches only."""
    batches = [row.letter_batch for row in keys.select("letter_batch").distinct().collect()]
    held = events.where((F.col("event") == DEAD_LETTERED) & F.col("batch_id").isin(batches))
    places = keys.select(*DELIVERY_KEY, F.col("letter_batch").alias("batch_id"))
    return pending_letters(held.join(places, [*DELIVERY_KEY, "batch_id"], "left_semi"), limit=None)


def restore_letters(pending: DataFrame) -> DataFrame:
    """Letters with their observation columns; ``restored`` is false where the JSON is broken."""
    parsed = pending.withColumn("_obs", restore_observation(F.col("observation_json")))
    kept = [c for c in pending.columns if c not in ("patient_id", "observation_json")]
    return parsed.select(
        *kept,
        F.col("_obs").isNotNull().alias("restored"),
        F.col("observation_json"),
        F.col("_obs.*"),
    )
