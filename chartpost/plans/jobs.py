"""Delivery, reprocessing, scoring and validation jobs."""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartpost.operators.backlog import (
    changed_dates,
    fold_dates,
    keys_per_date,
    on_dates,
    rows_per_date,
)
from chartpost.operators.circuit import (
    advance_circuit,
    circuit_tail,
    latest_counts,
    with_state,
)
from chartpost.operators.cohort import score_cohort, score_observations
from chartpost.operators.dead_letters import (
    changed_batches,
    dead_letter_rows,
    letters_of,
    pending_keys,
    reprocessed_rows,
    restore_letters,
    rows_per_part,
)
from chartpost.operators.dedup import DELIVERED, GATED, NEW, classify, fold_batch, gate, next_rows
from chartpost.operators.delivery import (
    EndpointHealth,
    OpenTransport,
    breaker_tasks,
    deliver,
    hold_back,
    split_waves,
    spread_requests,
)
from chartpost.operators.expectations import (
    cohort_rules,
    delivery_rules,
    keep_invalid,
    keep_valid,
    observation_rules,
    quarantine_rows,
)
from chartpost.operators.ledger import (
    current_ledger,
    delivered_keys,
    ledger_rows,
    prune_dates,
    success_keys,
)
from chartpost.operators.normalize import to_observations, with_key, with_request
from chartpost.operators.outcomes import (
    CIRCUIT_OPEN,
    classify_responses,
    dead_letter_outcomes,
    gated_outcomes,
    resolve_attempts,
)
from chartpost.operators.patients import (
    IDENTIFIER_SYSTEM,
    create_outcomes,
    create_requests,
    known_patients,
    mark_unmapped,
    patients_to_create,
)
from chartpost.operators.reports import (
    batch_summary,
    latest,
    status_counts,
    validation_summary,
)
from chartpost.policies import BATCH_RETRY, REPROCESS_RETRY, Breaker, Retries
from chartpost.schemas import (
    DEAD_LETTERED,
    DELIVERY_KEY,
    FAILED,
    OBSERVATION,
    REPROCESSED,
    SUCCESS,
)
from chartpost.session import prepare_session
from chartpost.sources.routes import ROUTES, Route, check_route
from chartpost.sources.tables import (
    Workspace,
    append_rows,
    batch_path,
    drop_batch,
    is_complete,
    read_table,
    replace_batch,
    write_once,
)

PLAN_COLUMNS = [
    *DELIVERY_KEY,
    "endpoint",
    "outcome",
    "occurrences",
    "queued_at",
    "planned_at",
    "effective_date",
    "circuit_state",
    "circuit_failures",
    "circuit_last_failure_at",
    *OBSERVATION.fieldNames(),
]


@dataclass(frozen=True)
class Endpoint:
    """Where a job sends, and how."""

    ehr_system: str
    api: str
    base_url: str
    open_transport: OpenTransport
    token_provider: Callable[[], str] = lambda: ""
    max_concurrency: int = 5
    max_rows_per_wave: int = 500_000
    retry: Retries = BATCH_RETRY
    circuit: Breaker | None = field(default_factory=Breaker)
    sleep: Callable[[float], None] = time.sleep
    routes: tuple[Route, ...] = ROUTES


MARKER_CONF = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def _check(spark: SparkSession, batch_id: str, endpoint: Endpoint) -> None:
    prepare_session(spark)
    check_route(endpoint.ehr_system, endpoint.api, endpoint.routes)
    if spark.sparkContext._jsc.hadoopConfiguration().get(MARKER_CONF, "true") == "false":
        raise RuntimeError(f"restarts rely on completion markers; do not turn {MARKER_CONF} off")
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch_id):
        raise ValueError(f"batch id {batch_id!r} cannot name a partition")
    if spark.conf.get("spark.speculation", "false") == "true":
        raise RuntimeError("speculative execution would send requests twice; turn it off")


def _stored_summary(
    spark: SparkSession, workspace: Workspace, batch_id: str
) -> DataFrame | None:
    """The summary of a batch that has finished."""
    if not is_complete(spark, batch_path(workspace, "delivery_batches", batch_id=batch_id)):
        return None
    return read_table(spark, workspace, "delivery_batches").where(F.col("batch_id") == batch_id)


def _quarantine(
    spark: SparkSession, workspace: Workspace, rejected: DataFrame, batch_id: str
) -> None:
    """Store rejected rows (see ``quarantine_rows``) that no other batch has stored."""
    earlier = (
        read_table(spark, workspace, "quarantine")
        .where(F.col("batch_id") != batch_id)
        .select("row_hash")
        .distinct()
    )
    fresh = rejected.join(earlier, "row_hash", "left_anti")
    write_once(spark, fresh, workspace, "quarantine", batch_id=batch_id)


def _addressed(observations: DataFrame, endpoint: Endpoint) -> DataFrame:
    return with_key(observations).withColumns(
        {
            "ehr_system": F.lit(endpoint.ehr_system),
            "api": F.lit(endpoint.api),
            "endpoint": F.lit(endpoint.base_url),
        }
    )


def _circuit(
    spark: SparkSession, workspace: Workspace, endpoint: Endpoint, now: Column
) -> DataFrame:
    """The endpoint's circuit: one row, or none where it is closed or not watched."""
    snapshots = read_table(spark, workspace, "circuit_snapshots").where(
        F.col("endpoint") == endpoint.base_url
    )
    if endpoint.circuit is None:
        return F.broadcast(with_state(latest_counts(snapshots.limit(0)), now))
    return F.broadcast(with_state(latest_counts(snapshots), now, endpoint.circuit))


def _write_plan(
    spark: SparkSession,
    workspace: Workspace,
    classified: DataFrame,
    endpoint: Endpoint,
    path: str,
) -> None:
    """Gate the classified keys and store them; skipped keys without their observation."""
    now = F.current_timestamp()
    gated = gate(classified, _circuit(spark, workspace, endpoint, now)).withColumn("planned_at", now)
    skipped = F.col("outcome") == DELIVERED
    kept = {*DELIVERY_KEY, "outcome", "occurrences", "effective_date"}
    gated.select(
        *[
            F.col(c) if c in kept else F.when(~skipped, F.col(c)).alias(c)
            for c in PLAN_COLUMNS
        ]
    ).write.mode("overwrite").parquet(path)


def _is_open(policy: Breaker | None, failures: int, last_failure_at: datetime | None) -> bool:
    """Whether the counts mean an open circuit now."""
    if policy is None or last_failure_at is None:
        return False
    return EndpointHealth(failures, last_failure_at.timestamp()).is_open(policy, time.time())


def _send(
    spark: SparkSession,
    workspace: Workspace,
    endpoint: Endpoint,
    batch_id: str,
    rows: DataFrame,
    to_requests: Callable[[DataFrame], DataFrame],
) -> None:
    """Send wave by wave; a wave that is in the log is not sent again.

    The circuit is known again before each wave: the counts the plan started with,
    moved on by the attempts of every finished wave.  A wave that would start while it is
    open is held back as a whole.
    """
    waves_path = workspace.path(f"plans/{batch_id}/waves")
    if not is_complete(spark, waves_path):
        split_waves(rows, rows.count(), endpoint.max_rows_per_wave).write.mode(
            "overwrite"
        ).partitionBy("wave").parquet(waves_path)
    schema = T.StructType([*rows.schema.fields, T.StructField("wave", T.IntegerType())])
    planned = spark.read.schema(schema).parquet(waves_path)
    last = planned.agg(F.max("wave")).first()[0]
    if last is None:
        return
    tasks, shared = breaker_tasks(spark, endpoint.max_concurrency, endpoint.circuit)
    start = planned.select("circuit_failures", "circuit_last_failure_at").first()
    failures, last_failure_at = start.circuit_failures, start.circuit_last_failure_at
    for wave in range(last + 1):
        log = batch_path(workspace, "attempt_log", batch_id=batch_id, wave=wave)
        if not is_complete(spark, log):
            due = planned.where(F.col("wave") == wave).withColumns(
                {
                    "circuit_failures": F.lit(failures).cast("bigint"),
                    "circuit_last_failure_at": F.lit(last_failure_at).cast("timestamp"),
                }
            )
            if _is_open(endpoint.circuit, failures, last_failure_at):
                attempts = hold_back(due)
            else:
                attempts = deliver(
                    spread_requests(to_requests(due), tasks),
                    endpoint.open_transport,
                    retry=endpoint.retry,
                    circuit=endpoint.circuit,
                    token=endpoint.token_provider,
                    sleep=endpoint.sleep,
                    shared=shared,
                )
            # The only action that sends.
            replace_batch(attempts, workspace, "attempt_log", batch_id=batch_id, wave=wave)
        if endpoint.circuit is not None and wave < last:
            # One endpoint, so one row.
            done = circuit_tail(
                read_table(spark, workspace, "attempt_log").where(
                    (F.col("batch_id") == batch_id) & (F.col("wave") == wave)
                )
            ).first()
            if done is not None:
                failures = done.failures + (0 if done.has_success else failures)
                last_failure_at = done.last_failure_at or last_failure_at


def _run_plan(
    spark: SparkSession,
    workspace: Workspace,
    endpoint: Endpoint,
    batch_id: str,
    plan_path: str,
) -> tuple[DataFrame, DataFrame]:
    """Send the planned rows, resolve and record them; returns (outcomes, plan).

    Every step reads what the step before has stored, and a step that finished in an
    earlier run is not repeated, so a restarted batch does not send again.  Each state
    table holds a batch as a partition with its own completion marker.
    """
    plan = spark.read.parquet(plan_path)
    to_send = plan.where(F.col("outcome").isin(NEW, GATED))
    _send(
        spark,
        workspace,
        endpoint,
        batch_id,
        to_send.where(F.col("outcome") == NEW),
        lambda due: with_request(due, endpoint.base_url, endpoint.routes),
    )

    outcome_path = workspace.path(f"plans/{batch_id}/outcomes")
    if not is_complete(spark, outcome_path):
        attempts = read_table(spark, workspace, "attempt_log").where(
            F.col("batch_id") == batch_id
        )
        resolved = resolve_attempts(
            classify_responses(attempts, endpoint.routes), endpoint.retry.times
        ).unionByName(gated_outcomes(to_send))
        observed = to_send.select(*DELIVERY_KEY, "effective_date", *OBSERVATION.fieldNames())
        resolved.join(observed, list(DELIVERY_KEY)).withColumn(
            "batch_id", F.lit(batch_id)
        ).write.mode("overwrite").parquet(outcome_path)
    outcomes = spark.read.parquet(outcome_path)

    write_once(spark, ledger_rows(outcomes), workspace, "delivery_ledger", batch_id=batch_id)
    letters = dead_letter_rows(dead_letter_outcomes(outcomes))
    write_once(spark, letters, workspace, "dead_letters", batch_id=batch_id, event=DEAD_LETTERED)
    _write_snapshot(spark, workspace, endpoint, batch_id)
    return outcomes, plan.select("outcome", "occurrences")


def _write_snapshot(
    spark: SparkSession, workspace: Workspace, endpoint: Endpoint, batch_id: str
) -> None:
    """Circuit counts after this batch, so that the next one need not read old attempts."""
    if is_complete(spark, batch_path(workspace, "circuit_snapshots", batch_id=batch_id)):
        return
    snapshots = read_table(spark, workspace, "circuit_snapshots").where(
        (F.col("endpoint") == endpoint.base_url) & (F.col("batch_id") != batch_id)
    )
    attempts = read_table(spark, workspace, "attempt_log").where(F.col("batch_id") == batch_id)
    counts = advance_circuit(latest_counts(snapshots), attempts).withColumn(
        "taken_at", F.current_timestamp()
    )
    replace_batch(counts, workspace, "circuit_snapshots", batch_id=batch_id)


def _finish(
    spark: SparkSession,
    workspace: Workspace,
    batch_id: str,
    outcomes: DataFrame,
    planned: DataFrame,
) -> DataFrame:
    """Summary of the batch; quarantined are its rejected inputs, beside ``total``."""
    refused = read_table(spark, workspace, "quarantine").where(F.col("batch_id") == batch_id)
    counted = refused.agg(F.count(F.lit(1)).alias("quarantined"))
    # One row on either side.
    summary = batch_summary(outcomes, planned).withColumn("_one", F.lit(1))
    joined = summary.join(F.broadcast(counted.withColumn("_one", F.lit(1))), "_one")
    finished = joined.withColumn("finished_at", F.current_timestamp())
    write_once(spark, finished, workspace, "delivery_batches", batch_id=batch_id)
    return _stored_summary(spark, workspace, batch_id)


def _next_batch(
    spark: SparkSession, keyed: DataFrame, delivered: DataFrame, limit: int, path: str
) -> DataFrame:
    """The ``limit`` oldest undelivered keys with their rows, and one row of skipped counts.

    Keys and times alone are folded, matched and ordered; only the chosen keys, which
    are stored first, fetch their observations.  The rest of a long ready table leaves a
    count of what is delivered already.
    """
    thin = keyed.select(*DELIVERY_KEY, "endpoint", "queued_at", "effective_datetime", "effective_date")
    marked = classify(fold_batch(thin), delivered)
    if not is_complete(spark, path):
        chosen = next_rows(marked.where(F.col("outcome") == NEW), limit)
        chosen.select(*DELIVERY_KEY, "occurrences", "outcome").write.mode("overwrite").parquet(path)
    chosen = spark.read.parquet(path)
    matching = keyed.join(chosen.select(*DELIVERY_KEY), list(DELIVERY_KEY), "left_semi")
    rows = fold_batch(matching).drop("occurrences").join(chosen, list(DELIVERY_KEY))
    skipped = marked.where(F.col("outcome") == DELIVERED).agg(
        F.coalesce(F.sum("occurrences"), F.lit(0)).alias("occurrences")
    )
    return rows.unionByName(
        skipped.withColumn("outcome", F.lit(DELIVERED)), allowMissingColumns=True
    )


def deliver_observations(
    spark: SparkSession,
    workspace: Workspace,
    observations: DataFrame,
    endpoint: Endpoint,
    batch_id: str,
    limit: int | None = None,
    rejected: DataFrame | None = None,
) -> DataFrame:
    """Deliver normalised observations (with ``queued_at``); returns the one-row summary.

    Rows without patient, code, instant or a value JSON can carry go to the quarantine
    table, with what the caller has ``rejected`` before.  Every other row has a key, and
    is sent, skipped or dead-lettered; without a limit, total + quarantined (new ones) is
    the number of inputs.
    """
    _check(spark, batch_id, endpoint)
    done = _stored_summary(spark, workspace, batch_id)
    if done is not None:
        return done
    rules = observation_rules()
    refused = quarantine_rows(keep_invalid(observations, rules))
    if rejected is not None:
        refused = refused.unionByName(rejected)
    _quarantine(spark, workspace, refused, batch_id)
    plan_path = workspace.path(f"plans/{batch_id}/classified")
    if not is_complete(spark, plan_path):
        valid = keep_valid(observations, rules)
        keyed = _addressed(valid, endpoint)
        ledger = prune_dates(read_table(spark, workspace, "delivery_ledger"), valid).where(
            (F.col("ehr_system") == endpoint.ehr_system) & (F.col("api") == endpoint.api)
        )
        delivered = success_keys(ledger)
        if limit is None:
            classified = classify(fold_batch(keyed), delivered)
        else:
            chosen_path = workspace.path(f"plans/{batch_id}/chosen")
            classified = _next_batch(spark, keyed, delivered, limit, chosen_path)
        _write_plan(spark, workspace, classified, endpoint, plan_path)
    outcomes, planned = _run_plan(spark, workspace, endpoint, batch_id, plan_path)
    return _finish(spark, workspace, batch_id, outcomes, planned)


def run_delivery_batch(
    spark: SparkSession,
    workspace: Workspace,
    endpoint: Endpoint,
    batch_id: str,
    limit: int | None = 100,
    queued_since: str | None = None,
) -> DataFrame:
    """Deliver from the ready table: by default the 100 oldest undelivered keys.

    A batch reads the dates whose rows have changed since the endpoint's last batch, and the
    keys that batch left over; rows are fetched for the chosen keys only.
    ``queued_since`` (a date) looks at later ready partitions alone and leaves that
    state as it is.  Rows without a deliverable value or instant go to the quarantine table,
    each once.
    """
    ready = read_table(spark, workspace, "observations_ready")
    if queued_since is not None:
        ready = ready.where(F.col("queued_date") >= F.lit(queued_since).cast("date"))
        ready = ready.drop("queued_date")
        rules = delivery_rules(ready.columns)
        rejected = quarantine_rows(keep_invalid(ready, rules))
        observations = to_observations(keep_valid(ready, rules))
        return deliver_observations(
            spark, workspace, observations, endpoint, batch_id, limit, rejected
        )
    _check(spark, batch_id, endpoint)
    done = _stored_summary(spark, workspace, batch_id)
    if done is not None:
        return done
    plan_path = workspace.path(f"plans/{batch_id}/classified")
    if not is_complete(spark, plan_path):
        _refresh_backlog(spark, workspace, endpoint, batch_id, ready)
        chosen = _choose(spark, workspace, endpoint, batch_id, ready, limit)
        _write_plan(spark, workspace, chosen, endpoint, plan_path)
    outcomes, planned = _run_plan(spark, workspace, endpoint, batch_id, plan_path)
    summary = _finish(spark, workspace, batch_id, outcomes, planned)
    for old in _states(spark, workspace, endpoint, "ready_dates")[2:]:
        for table in ("ready_dates", "backlog"):
            drop_batch(spark, workspace, table, batch_id=old)
    return summary


def _states(spark: SparkSession, workspace: Workspace, endpoint: Endpoint, table: str) -> list[str]:
    """Batches whose state of this endpoint is complete, newest first (a few: old ones go)."""
    taken = (
        read_table(spark, workspace, table)
        .where((F.col("ehr_system") == endpoint.ehr_system) & (F.col("api") == endpoint.api))
        .groupBy("batch_id")
        .agg(F.max("taken_at").alias("taken_at"))
        .orderBy(F.desc("taken_at"), F.desc("batch_id"))
    )
    return [
        row.batch_id
        for row in taken.collect()
        if is_complete(spark, batch_path(workspace, table, batch_id=row.batch_id))
    ]


def _keyed_dates(ready: DataFrame, endpoint: Endpoint) -> DataFrame:
    """Deliverable ready rows, normalised and keyed, with their date."""
    return _addressed(to_observations(keep_valid(ready, delivery_rules(ready.columns))), endpoint)


def _refresh_backlog(
    spark: SparkSession, workspace: Workspace, endpoint: Endpoint, batch_id: str, ready: DataFrame
) -> None:
    """Store what is undelivered as of this batch, from the last batch's state and what changed.

    Rows of changed dates are keyed anew (and put aside where they cannot be delivered);
    other dates keep their counts, and their undelivered keys are looked up in the ledger
    again.  The dates are written last, so their marker says that both tables are whole.
    """
    if is_complete(spark, batch_path(workspace, "ready_dates", batch_id=batch_id)):
        return
    states = [s for s in _states(spark, workspace, endpoint, "ready_dates") if s != batch_id]
    last = states[0] if states else None
    dates = read_table(spark, workspace, "ready_dates").where(F.col("batch_id") == last)
    earlier = read_table(spark, workspace, "backlog").where(F.col("batch_id") == last)
    counted = rows_per_date(ready)
    days = changed_dates(counted, dates)
    fresh = ready.where(on_dates(days))
    rejected = keep_invalid(fresh.drop("queued_date"), delivery_rules(ready.columns))
    _quarantine(spark, workspace, quarantine_rows(rejected), batch_id)

    keys_path = workspace.path(f"plans/{batch_id}/fresh_keys")
    if not is_complete(spark, keys_path):
        keys_per_date(_keyed_dates(fresh, endpoint)).write.mode("overwrite").parquet(keys_path)
    fresh_keys = spark.read.parquet(keys_path)
    per_date = earlier.where(~on_dates(days)).drop("batch_id").unionByName(fresh_keys)
    ledger = prune_dates(read_table(spark, workspace, "delivery_ledger"), per_date.drop("effective_datetime")).where(
        (F.col("ehr_system") == endpoint.ehr_system) & (F.col("api") == endpoint.api)
    )
    left = per_date.join(success_keys(ledger), list(DELIVERY_KEY), "left_anti")
    write_once(spark, left, workspace, "backlog", batch_id=batch_id)

    valid = fresh_keys.groupBy(F.col("queued_date").alias("_date")).agg(F.sum("occurrences").alias("_valid"))
    kept = dates.where(~on_dates(days)).select(F.col("queued_date").alias("_date"), F.col("n_valid").alias("_valid"))
    state = counted.join(valid.unionByName(kept), F.col("queued_date").eqNullSafe(F.col("_date")), "left")
    state = state.withColumns(
        {
            "ehr_system": F.lit(endpoint.ehr_system),
            "api": F.lit(endpoint.api),
            "n_valid": F.coalesce("_valid", F.lit(0)),
            "taken_at": F.current_timestamp(),
        }
    )
    write_once(spark, state, workspace, "ready_dates", batch_id=batch_id)


def _choose(
    spark: SparkSession,
    workspace: Workspace,
    endpoint: Endpoint,
    batch_id: str,
    ready: DataFrame,
    limit: int | None,
) -> DataFrame:
    """The oldest keys of the stored backlog with their rows, and one row of skipped counts.

    What is deliverable but not in the backlog has been delivered.
    """
    per_date = read_table(spark, workspace, "backlog").where(F.col("batch_id") == batch_id)
    path = workspace.path(f"plans/{batch_id}/chosen")
    if not is_complete(spark, path):
        folded = fold_dates(per_date).withColumn("outcome", F.lit(NEW))
        chosen = next_rows(folded, limit).select(*DELIVERY_KEY, "occurrences", "outcome")
        chosen.write.mode("overwrite").parquet(path)
    chosen = spark.read.parquet(path)
    keys = chosen.select(*DELIVERY_KEY)
    days = per_date.join(keys, list(DELIVERY_KEY), "left_semi").select("queued_date").distinct()
    dated = ready.where(on_dates([row.queued_date for row in days.collect()]))
    matching = _keyed_dates(dated, endpoint).drop("queued_date")
    if limit is not None:
        # A few keys keep most rows out of the fold; all keys are matched after it, once each.
        matching = matching.join(keys, list(DELIVERY_KEY), "left_semi")
    rows = fold_batch(matching).drop("occurrences").join(chosen, list(DELIVERY_KEY))
    seen = read_table(spark, workspace, "ready_dates").where(F.col("batch_id") == batch_id)
    counts = seen.agg(F.coalesce(F.sum("n_valid"), F.lit(0)).alias("_valid")).withColumn("_one", F.lit(1))
    open_ = per_date.agg(F.coalesce(F.sum("occurrences"), F.lit(0)).alias("_open")).withColumn("_one", F.lit(1))
    # One row on either side.
    skipped = counts.join(F.broadcast(open_), "_one").select(
        (F.col("_valid") - F.col("_open")).alias("occurrences"), F.lit(DELIVERED).alias("outcome")
    )
    return rows.unionByName(skipped, allowMissingColumns=True)


def _refresh_pending(
    spark: SparkSession, workspace: Workspace, endpoint: Endpoint, batch_id: str
) -> None:
    """Store the keys pending as of this batch, from the last state and the batches since.

    The counts of partitions are written last, so their marker says that both tables are
    whole.
    """
    if is_complete(spark, batch_path(workspace, "letter_parts", batch_id=batch_id)):
        return
    states = [s for s in _states(spark, workspace, endpoint, "letter_parts") if s != batch_id]
    last = states[0] if states else None
    before = read_table(spark, workspace, "letter_parts").where(F.col("batch_id") == last)
    earlier = read_table(spark, workspace, "pending_keys").where(F.col("batch_id") == last)
    events = read_table(spark, workspace, "dead_letters")
    # Stored first: rows that come in between count as changed next time.
    counted_path = workspace.path(f"plans/{batch_id}/letter_parts")
    if not is_complete(spark, counted_path):
        rows_per_part(events).write.mode("overwrite").parquet(counted_path)
    counted = spark.read.parquet(counted_path)
    mine = events.where((F.col("ehr_system") == endpoint.ehr_system) & (F.col("api") == endpoint.api))
    if last is not None:
        mine = mine.where(F.col("batch_id").isin(changed_batches(counted, before)))
    write_once(spark, pending_keys(earlier, mine), workspace, "pending_keys", batch_id=batch_id)
    state = counted.withColumns(
        {
            "ehr_system": F.lit(endpoint.ehr_system),
            "api": F.lit(endpoint.api),
            "taken_at": F.current_timestamp(),
        }
    )
    write_once(spark, state, workspace, "letter_parts", batch_id=batch_id)


def reprocess_dead_letters(
    spark: SparkSession,
    workspace: Workspace,
    endpoint: Endpoint,
    batch_id: str,
    limit: int | None = 500,
) -> DataFrame:
    """Send pending letters again; delivered ones (now or meanwhile) are marked.

    A run reads the letters and marks of batches since the endpoint's last run and the keys
    that were pending then; whole letters are fetched for the chosen keys only.  A letter
    whose JSON cannot be restored goes to the quarantine table; it stays pending and takes
    no place in the limit.
    """
    _check(spark, batch_id, endpoint)
    done = _stored_summary(spark, workspace, batch_id)
    if done is not None:
        return done
    letters = read_table(spark, workspace, "dead_letters")
    plan_path = workspace.path(f"plans/{batch_id}/classified")
    if not is_complete(spark, plan_path):
        _refresh_pending(spark, workspace, endpoint, batch_id)
        pending = read_table(spark, workspace, "pending_keys").where(F.col("batch_id") == batch_id)
        unread = restore_letters(letters_of(letters, pending.where("not readable")))
        broken = unread.withColumn("failed_rules", F.lit("readable_letter"))
        _quarantine(spark, workspace, quarantine_rows(broken), batch_id)
        readable = pending.where("readable").withColumn("queued_at", F.col("dead_lettered_at"))
        chosen_path = workspace.path(f"plans/{batch_id}/chosen")
        if not is_complete(spark, chosen_path):
            chosen = next_rows(readable, limit).select(*DELIVERY_KEY, "letter_batch")
            chosen.write.mode("overwrite").parquet(chosen_path)
        restored = restore_letters(letters_of(letters, spark.read.parquet(chosen_path)))
        batch = restored.withColumns(
            {
                "queued_at": F.col("dead_lettered_at"),
                "occurrences": F.lit(1).cast("bigint"),
                "endpoint": F.lit(endpoint.base_url),
                "effective_date": F.to_date("effective_datetime"),
            }
        )
        ledger = prune_dates(read_table(spark, workspace, "delivery_ledger"), batch)
        classified = classify(batch, delivered_keys(ledger, batch))
        _write_plan(spark, workspace, classified, endpoint, plan_path)
    outcomes, planned = _run_plan(spark, workspace, endpoint, batch_id, plan_path)
    marked = (
        spark.read.parquet(plan_path)
        .where(F.col("outcome") == DELIVERED)
        .select(*DELIVERY_KEY)
        .unionByName(outcomes.where(F.col("status") == SUCCESS).select(*DELIVERY_KEY))
    )
    marks = reprocessed_rows(marked, F.current_timestamp(), batch_id)
    write_once(spark, marks, workspace, "dead_letters", batch_id=batch_id, event=REPROCESSED)
    summary = _finish(spark, workspace, batch_id, outcomes, planned)
    for old in _states(spark, workspace, endpoint, "letter_parts")[2:]:
        for table in ("letter_parts", "pending_keys"):
            drop_batch(spark, workspace, table, batch_id=old)
    return summary


def reprocess_endpoint(endpoint: Endpoint) -> Endpoint:
    """The endpoint with the shorter retry policy of the reprocessing job."""
    from dataclasses import replace

    return replace(endpoint, retry=REPROCESS_RETRY)


def register_patients(
    spark: SparkSession,
    workspace: Workspace,
    patients: DataFrame,
    endpoint: Endpoint,
    batch_id: str,
    identifier_system: str = IDENTIFIER_SYSTEM,
) -> DataFrame:
    """Create the patients (patient_id, name) that the endpoint has not answered for yet.

    Returns one row per patient asked for in this batch: created, known (there before) or
    failed, with the endpoint's id.  These rows are the batch's partition of
    ``patient_links``, which later phases map patients by.  Requests go out in waves
    like observations, under the same breaker, and a logged wave is not sent again.  A
    patient who failed is asked for again by the next batch; null ids are not asked for.
    """
    _check(spark, batch_id, endpoint)
    log_id = f"{batch_id}.patients"
    done = batch_path(workspace, "patient_links", batch_id=log_id)
    if not is_complete(spark, done):
        plan_path = workspace.path(f"plans/{log_id}/classified")
        if not is_complete(spark, plan_path):
            links = read_table(spark, workspace, "patient_links")
            known = known_patients(links, endpoint.base_url)
            missing = patients_to_create(patients, known, identifier_system).withColumns(
                {
                    "idempotency_key": F.sha2("if_none_exist", 256),
                    "ehr_system": F.lit(endpoint.ehr_system),
                    "api": F.lit(endpoint.api),
                    "endpoint": F.lit(endpoint.base_url),
                    "outcome": F.lit(NEW),
                    "queued_at": F.lit(None).cast("timestamp"),
                    "effective_datetime": F.lit(None).cast("timestamp"),
                }
            )
            now = F.current_timestamp()
            gated = gate(missing, _circuit(spark, workspace, endpoint, now))
            gated.withColumn("planned_at", now).write.mode("overwrite").parquet(plan_path)
        plan = spark.read.parquet(plan_path)
        to_send = plan.where(F.col("outcome") == NEW)
        _send(
            spark, workspace, endpoint, log_id, to_send,
            lambda due: create_requests(due, endpoint.base_url),
        )
        attempts = read_table(spark, workspace, "attempt_log").where(F.col("batch_id") == log_id)
        answered = to_send.select("idempotency_key", "patient_id", "endpoint").join(
            create_outcomes(attempts), "idempotency_key"
        )
        held_back = plan.where(F.col("outcome") == GATED).select(
            "idempotency_key",
            "patient_id",
            "endpoint",
            F.lit(None).cast("string").alias("endpoint_patient_id"),
            F.lit(FAILED).alias("status"),
            F.lit(CIRCUIT_OPEN).alias("error_message"),
            F.col("planned_at").alias("attempted_at"),
        )
        _write_snapshot(spark, workspace, endpoint, log_id)
        rows = answered.unionByName(held_back)
        write_once(spark, rows, workspace, "patient_links", batch_id=log_id)
    return read_table(spark, workspace, "patient_links").where(F.col("batch_id") == log_id)


def score_and_deliver(
    spark: SparkSession,
    workspace: Workspace,
    measurements: DataFrame,
    patient_map: DataFrame,
    endpoint: Endpoint,
    batch_id: str,
) -> DataFrame:
    """Score measurements, map patients to endpoint ids and deliver both observations.

    Measurements that break a rule, or whose patient the map does not hold or holds with
    several ids, go to the quarantine table, one row each: measurements = total / 2 +
    quarantined.
    """
    rules = cohort_rules()
    mapped = mark_unmapped(keep_valid(measurements, rules), patient_map)
    known = F.col("endpoint_patient_id").isNotNull()
    reason = F.when(F.col("ambiguous"), F.lit("ambiguous_patient")).otherwise(F.lit("mapped_patient"))
    unmapped = mapped.where(~known).withColumn("failed_rules", reason)
    rejected = quarantine_rows(keep_invalid(measurements, rules)).unionByName(
        quarantine_rows(unmapped.drop("endpoint_patient_id", "ambiguous"))
    )
    scored = score_cohort(mapped.where(known).drop("ambiguous"))
    scores = scored.withColumn("patient_id", F.col("endpoint_patient_id"))
    rows = score_observations(scores).withColumn("queued_at", F.col("effective_datetime"))
    return deliver_observations(
        spark, workspace, to_observations(rows), endpoint, batch_id, rejected=rejected
    )


def register_and_score(
    spark: SparkSession,
    workspace: Workspace,
    patients: DataFrame,
    measurements: DataFrame,
    endpoint: Endpoint,
    batch_id: str,
) -> DataFrame:
    """Create missing patients, then score and deliver under the ids the endpoint gave them.

    Measurements of patients who could not be created are put aside, not lost.
    """
    register_patients(spark, workspace, patients, endpoint, batch_id)
    links = read_table(spark, workspace, "patient_links")
    known = known_patients(links, endpoint.base_url)
    return score_and_deliver(spark, workspace, measurements, known, endpoint, batch_id)


def compact_ledger(spark: SparkSession, workspace: Workspace, target: Workspace) -> None:
    """Write the current view into another workspace, which then takes over.

    Nothing is replaced in place, so a running batch keeps a consistent ledger.
    """
    append_rows(
        current_ledger(read_table(spark, workspace, "delivery_ledger")), target, "delivery_ledger"
    )


def validate_run(spark: SparkSession, workspace: Workspace) -> dict[str, DataFrame]:
    """Reports of the validation job, as lazy DataFrames."""
    log = current_ledger(read_table(spark, workspace, "delivery_ledger"))
    letters = read_table(spark, workspace, "dead_letters").where(
        F.col("event") == "dead_lettered"
    )
    return {
        "summary": validation_summary(
            read_table(spark, workspace, "observations_queue"), log, letters
        ),
        "status_counts": status_counts(log),
        "latest_log": latest(log, "attempted_at", *DELIVERY_KEY, "seq"),
        "latest_dead_letters": latest(letters, "event_at", *DELIVERY_KEY, "seq"),
    }
