"""Registry: one query per operator, over the supplied tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartpost.functions import payloads, retry, scoring, text, values
from chartpost.functions.keys import idempotency_key
from chartpost.operators import (
    circuit,
    cohort,
    dead_letters,
    dedup,
    delivery,
    expectations,
    ledger,
    normalize,
    outcomes,
    patients,
    readback,
    reports,
)
from chartpost.operators.skew import plain_side
from chartpost.plans import bindings as b
from chartpost.plans.jobs import (
    Endpoint,
    register_patients,
    reprocess_dead_letters,
    reprocess_endpoint,
    run_delivery_batch,
    score_and_deliver,
    validate_run,
)
from chartpost.plans.scripted import scripted_answer, scripted_patients, scripted_transport
from chartpost.policies import Breaker, Retries
from chartpost.schemas import DELIVERY_KEY, QUEUE
from chartpost.session import prepare_session, shared_dir
from chartpost.sources.routes import with_route
from chartpost.sources.tables import Workspace, demo_rows, ensure_tables, read_table, replace_batch
from chartpost.streaming.ready import refresh_ready

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
KEY = list(DELIVERY_KEY)


def query(fn: Query) -> Query:
    """Register ``fn``; instants leave as zone-less UTC."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = fn(prepare_session(spark), sf_dir)
        instants = [f.name for f in out.schema.fields if f.dataType.typeName() == "timestamp"]
        return out.withColumns({name: F.col(name).cast("timestamp_ntz") for name in instants})

    QUERIES[fn.__name__] = run
    return run


# --- scans, sources, sinks ------------------------------------------------------------


@query
def next_ready_batch(spark, d):
    """A2: the oldest rows that are not delivered yet."""
    folded = dedup.fold_batch(b.batch(spark, d))
    delivered = ledger.success_keys(b.ledger_events(spark, d))
    pending = dedup.drop_delivered(folded, delivered)
    return dedup.next_rows(pending, 100).select(*KEY, "patient_id", "code", "queued_at")


@query
def pending_dead_letters(spark, d):
    """A3: oldest pending letters."""
    pending = dead_letters.pending_letters(b.dead_letter_events(spark, d), limit=100)
    return pending.select(
        *KEY, "patient_id", "observation_code", "last_error", "retry_count", "dead_lettered_at"
    )


@query
def demo_queue(spark, d):
    """A4: deterministic queue rows, one per event."""
    index = b.load(spark, d, "events").select(F.col("event_id").alias("index"))
    return demo_rows(index)


@query
def ledger_current(spark, d):
    """What an upsert by key leaves."""
    return ledger.current_ledger(b.ledger_events(spark, d)).select(
        *KEY,
        "patient_id",
        "observation_code",
        "ehr_resource_id",
        "status",
        "attempted_at",
        "error_message",
        "retry_count",
    )


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    """Outcomes of the attempts view, joined with their observation."""
    log = b.attempts(spark, d)
    resolved = outcomes.resolve_attempts(outcomes.classify_responses(log), 3)
    events = b.load(spark, d, "events").withColumn(
        "patient_id", F.concat(F.lit("P"), F.col("user_id"))
    )
    observed = events.select(
        idempotency_key(F.col("patient_id"), F.col("event_type"), F.col("ts")).alias(
            "idempotency_key"
        ),
        "patient_id",
        F.lit(None).cast("string").alias("encounter_id"),
        F.col("event_type").alias("code"),
        F.lit("http://loinc.org").alias("code_system"),
        F.col("event_type").alias("display_name"),
        F.lit("number").alias("value_type"),
        F.col("value").alias("value_num"),
        F.lit(None).cast("string").alias("value_str"),
        F.lit(None).cast("boolean").alias("value_bool"),
        F.lit("%").alias("unit"),
        F.col("ts").alias("effective_datetime"),
        F.lit("feed").alias("source_system"),
        F.col("props").alias("metadata_json"),
        F.to_date("ts").alias("effective_date"),
        F.lit("b1").alias("batch_id"),
    )
    return resolved.join(observed, "idempotency_key")


@query
def dead_letter_append(spark, d):
    """Rows appended for exhausted deliveries, with the observation JSON."""
    rows = dead_letters.dead_letter_rows(
        outcomes.dead_letter_outcomes(_resolved(spark, d))
    )
    return rows.select(
        "event",
        *KEY,
        "patient_id",
        "observation_code",
        "observation_json",
        "last_error",
        "retry_count",
        "event_at",
    )


@query
def dead_letter_states(spark, d):
    """Every letter with its reprocessed flag."""
    states = dead_letters.letter_states(b.dead_letter_events(spark, d))
    return states.select(
        *KEY, "patient_id", "observation_code", "last_error", "dead_lettered_at", "reprocessed"
    )


@query
def ledger_append(spark, d):
    """Successes and dead letters recorded in one write."""
    return ledger.ledger_rows(_resolved(spark, d)).drop("batch_id", "effective_date")


@query
def ledger_changes(spark, d):
    """A10: insert and update images per ledger event."""
    return ledger.change_feed(b.ledger_events(spark, d)).select(
        "change_type", "changed_at", *KEY, "status", "ehr_resource_id", "retry_count", "seq"
    )


@query
def restored_letters(spark, d):
    """Observations restored from letter JSON, broken ones flagged."""
    pending = dead_letters.pending_letters(b.dead_letter_events(spark, d), limit=None)
    return dead_letters.restore_letters(pending).select(
        *KEY,
        "restored",
        "patient_id",
        "encounter_id",
        "code",
        "code_system",
        "value_type",
        "value_num",
        "value_str",
        "value_bool",
        "unit",
        "effective_datetime",
        "source_system",
    )


def _requests(spark: SparkSession, d: str) -> DataFrame:
    folded = dedup.fold_batch(b.batch(spark, d)).withColumns(
        {
            "circuit_failures": F.lit(0).cast("bigint"),
            "circuit_last_failure_at": F.lit(None).cast("timestamp"),
        }
    )
    return normalize.with_request(folded, F.concat(F.lit("https://"), F.col("endpoint")))


@query
def delivery_attempts(spark, d):
    """Every attempt of sending the folded batch to a scripted endpoint."""
    requests = delivery.spread_requests(_requests(spark, d), 5)
    log = delivery.deliver(
        requests, scripted_transport(), Retries(), circuit=None, sleep=_no_wait
    )
    return log.select(
        *KEY, "endpoint", "attempt", "http_status", "body", "ok", "effective_date"
    ).withColumn("effective_date", F.col("effective_date").cast("string"))


def _no_wait(seconds: float) -> None:
    """Scripted runs do not sleep."""


# --- projections, filters, validation -------------------------------------------------


@query
def drop_missing_patient(spark, d):
    """B1."""
    rule = {"valid_patient": expectations.queue_rules()["valid_patient"]}
    kept = expectations.keep_valid(b.obs_queue(spark, d), rule)
    return kept.select("event_id", "patient_id", "observation_code")


@query
def drop_missing_code(spark, d):
    """B2."""
    rule = {"valid_code": expectations.queue_rules()["valid_code"]}
    kept = expectations.keep_valid(b.obs_queue(spark, d), rule)
    return kept.select("event_id", "patient_id", "observation_code")


@query
def expectation_counts(spark, d):
    """Passed and failed rows per rule."""
    queue = b.obs_queue(spark, d)
    return expectations.expectation_report(queue, expectations.delivery_rules(queue.columns))


@query
def quarantined_rows(spark, d):
    """Rows that cannot be delivered, with the rules they break."""
    queue = b.obs_queue(spark, d)
    bad = expectations.keep_invalid(queue, expectations.delivery_rules(queue.columns))
    return bad.select("event_id", "failed_rules")


@query
def ready_projection(spark, d):
    """The thirteen ready columns (queue time injected)."""
    return normalize.ready_rows(b.obs_queue(spark, d), F.col("queued_at"))


@query
def normalized_observations(spark, d):
    """Observation defaults."""
    return b.observations(spark, d).select(
        "event_id",
        "patient_id",
        "encounter_id",
        "code",
        "code_system",
        "display_name",
        "unit",
        "effective_datetime",
        "source_system",
        "metadata_json",
    )


@query
def value_dispatch(spark, d):
    """Boolean before number before text."""
    return b.observations(spark, d).select(
        "event_id", "value_type", "value_num", "value_str", "value_bool"
    )


@query
def success_lookup(spark, d):
    """Keys whose current status is success."""
    return ledger.success_keys(b.ledger_events(spark, d))


@query
def route_resolution(spark, d):
    """B10."""
    return with_route(b.observations(spark, d)).select(
        "event_id",
        "ehr_system",
        "api",
        "key_prefix",
        "path",
        "content_type",
        "accept",
        "returns_id",
    )


# --- scalar functions -----------------------------------------------------------------


@query
def default_keys(spark, d):
    """C1."""
    return b.observations(spark, d).select("event_id", "idempotency_key")


@query
def routed_keys(spark, d):
    """Request ids with the route prefix."""
    routed = with_route(b.observations(spark, d))
    key = idempotency_key(
        F.col("patient_id"), F.col("code"), F.col("effective_datetime"), F.col("key_prefix")
    )
    return routed.select("event_id", key.alias("request_id"))


@query
def instant_text(spark, d):
    """Both text forms of an instant, with and without a fraction."""
    events = b.load(spark, d, "events")
    return events.select(
        "event_id",
        text.iso_instant(F.col("ts")).alias("iso_text"),
        text.iso_instant(F.date_trunc("second", "ts")).alias("iso_whole_text"),
        text.utc_seconds_instant(F.col("ts")).alias("seconds_text"),
    )


@query
def fhir_payloads(spark, d):
    """FHIR Observation JSON."""
    return b.observations(spark, d).select(
        "event_id", payloads.fhir_observation().alias("payload")
    )


@query
def quantity_parts(spark, d):
    """The quantity object of numeric observations."""
    numeric = b.observations(spark, d).where(F.col("value_type") == values.NUMBER)
    return numeric.select(
        "event_id",
        F.to_json(payloads.quantity(F.col("value_num"), F.col("unit"))).alias("quantity"),
    )


@query
def reference_texts(spark, d):
    """C7."""
    return b.observations(spark, d).select(
        "event_id",
        payloads.reference("Patient", F.col("patient_id")).alias("subject"),
        payloads.reference("Encounter", F.col("encounter_id")).alias("encounter"),
    )


@query
def flowsheet_payloads(spark, d):
    """C8."""
    return b.observations(spark, d).select(
        "event_id", payloads.flowsheet_value().alias("payload")
    )


@query
def python_value_text(spark, d):
    """Doubles of many magnitudes as Python prints them."""
    scales = (1.0, 1e6, 1e9, 1e13, 1e14, 1e-3, 1e-5, 1e-7, -1.0, 0.0)
    scale: Column = F.lit(scales[0])
    for rest, factor in enumerate(scales[1:], start=1):
        scale = F.when(F.col("event_id") % len(scales) == rest, F.lit(factor)).otherwise(scale)
    scaled = b.load(spark, d, "events").select(
        "event_id", (F.col("value") * scale + F.lit(0.0)).alias("scaled")
    )
    return scaled.select("event_id", text.python_float_text(F.col("scaled")).alias("value_text"))


@query
def typed_value_text(spark, d):
    """Booleans, numbers and text as flowsheet values."""
    kind = [F.col(c) for c in ("value_type", "value_bool", "value_num", "value_str")]
    return b.observations(spark, d).select(
        "event_id", values.value_text(*kind).alias("value_text")
    )


@query
def metadata_lookup(spark, d):
    """C10."""
    return b.observations(spark, d).select(
        "event_id",
        payloads.metadata_text(F.col("metadata_json"), "flowsheet_template_id").alias("template"),
        payloads.metadata_text(F.col("metadata_json"), "k", "none").alias("k"),
    )


@query
def name_parts(spark, d):
    """C11."""
    return b.patients(spark, d).select(
        "patient_id",
        text.given_name(F.col("name")).alias("given"),
        text.family_name(F.col("name")).alias("family"),
    )


@query
def patient_payloads(spark, d):
    """C12, C13."""
    system = patients.IDENTIFIER_SYSTEM
    return b.patients(spark, d).select(
        "patient_id",
        payloads.fhir_patient(F.col("patient_id"), F.col("name"), system).alias("payload"),
        payloads.create_criterion(F.col("patient_id"), system).alias("criterion"),
    )


@query
def request_envelopes(spark, d):
    """C14: url, headers and body per delivery (headers as sorted text)."""
    entries = F.array_sort(
        F.transform(
            F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])
        )
    )
    return _requests(spark, d).select(
        *KEY,
        "url",
        F.array_join(entries, ";").alias("headers"),
        "request_id",
        F.md5("request_body").alias("body_md5"),
    )


def _stored(spark: SparkSession, d: str) -> DataFrame:
    """Resources as the endpoint holds them: a tenth lost, every fiftieth value changed."""
    e = F.col("event_id")
    rows = b.observations(spark, d).where(e % 10 != 3)
    changed = F.when(e % 50 == 0, F.col("value_num") + 1.0).otherwise(F.col("value_num"))
    return rows.withColumn("value_num", changed).select(
        F.concat(F.lit("r-"), e).alias("ehr_resource_id"),
        payloads.fhir_observation().alias("resource_json"),
    )


@query
def resource_readback(spark, d):
    """Stored resources as flat rows."""
    return readback.flatten_resources(_stored(spark, d))


@query
def fahrenheit_values(spark, d):
    """C16."""
    return b.measurements(spark, d).select(
        "event_id", scoring.fahrenheit(F.col("temperature_c")).alias("temperature_f")
    )


@query
def backoff_delays(spark, d):
    """C17: the delay that follows each logged attempt."""
    policy = Retries()
    log = b.attempts(spark, d)
    return log.select(
        "event_id",
        "attempt",
        retry.backoff_seconds(F.col("attempt"), policy).alias("delay_seconds"),
        retry.backoff_seconds(F.col("attempt") + 3, policy).alias("later_delay_seconds"),
    )


@query
def error_texts(spark, d):
    """Messages of failed attempts."""
    failed = b.attempts(spark, d).where(~F.col("ok"))
    message = retry.error_text(
        F.col("http_status"), F.col("body"), F.col("transport_error")
    )
    return failed.select("event_id", "attempt", message.alias("error_message"))


# --- joins, dedup, set logic ----------------------------------------------------------


def _delivered(spark: SparkSession, d: str) -> DataFrame:
    return ledger.success_keys(b.ledger_events(spark, d))


@query
def undelivered_observations(spark, d):
    """Rows of the batch whose key has not succeeded."""
    delivered = plain_side(_delivered(spark, d))
    return dedup.drop_delivered(b.batch(spark, d), delivered).select("event_id", *KEY)


@query
def skipped_keys(spark, d):
    """Delivered keys of the batch with their occurrences."""
    return dedup.skipped_rows(b.batch(spark, d), _delivered(spark, d))


@query
def duplicate_rows(spark, d):
    """D3: every row, flagged as the one sent for its key or a duplicate."""
    return dedup.flag_winners(b.batch(spark, d)).select("event_id", *KEY, "is_winner")


@query
def folded_batch(spark, d):
    """D3: one row per key with the number of occurrences."""
    return dedup.fold_batch(b.batch(spark, d)).select(*KEY, "event_id", "occurrences")


AS_OF = "2024-01-31 00:00:00"
GATE_POLICY = Breaker(limit=2, rest_seconds=20 * 86400.0)


def _classified(spark: SparkSession, d: str) -> DataFrame:
    folded = dedup.fold_batch(b.batch(spark, d))
    marked = dedup.classify(folded, _delivered(spark, d))
    states = circuit.circuit_state(
        b.attempts(spark, d), F.lit(AS_OF).cast("timestamp"), GATE_POLICY
    )
    return dedup.gate(marked, states)


@query
def batch_classes(spark, d):
    """Input rows per key and class; they add up to the batch."""
    return dedup.batch_partition(_classified(spark, d))


@query
def patients_to_create(spark, d):
    """D5."""
    return patients.patients_to_create(b.patients(spark, d), b.patient_map(spark, d))


@query
def mapped_patients(spark, d):
    """Measurement rows with the endpoint's patient id."""
    mapped = patients.map_patients(b.measurements(spark, d), b.patient_map(spark, d))
    return mapped.select("event_id", "patient_id")


@query
def unmapped_patients(spark, d):
    """Ids the map does not hold."""
    return patients.unmapped_patients(b.measurements(spark, d), b.patient_map(spark, d))


@query
def pairing_report(spark, d):
    """Strict pairing of patients and scores."""
    scores = cohort.score_cohort(b.measurements(spark, d))
    return patients.pairing_report(b.patients(spark, d), scores)


@query
def readback_reconciliation(spark, d):
    """Sent against stored; a twentieth of the sent rows got no id."""
    e = F.col("event_id")
    rid = F.when(e % 20 != 7, F.concat(F.lit("r-"), e))
    sent = b.observations(spark, d).withColumns(
        {
            "ehr_resource_id": rid,
            "unit": F.when(F.col("value_type") == "number", F.coalesce("unit", F.lit(""))),
        }
    )
    stored = readback.flatten_resources(_stored(spark, d))
    return readback.reconcile(sent, stored)


@query
def all_observations(spark, d):
    """Queue and score observations in one list."""
    columns = ["patient_id", "code", "display_name", "value_type", "value_num", "value_str"]
    scored = normalize.to_observations(
        cohort.score_observations(cohort.score_cohort(b.measurements(spark, d)))
    )
    return b.observations(spark, d).select(*columns).unionByName(scored.select(*columns))


# --- delivery outcome, retry, circuit -------------------------------------------------


@query
def response_classes(spark, d):
    """F1."""
    return outcomes.classify_responses(b.attempts(spark, d).drop("ok")).select(
        "event_id", "attempt", "status", "ehr_resource_id", "error_message"
    )


@query
def retry_resolution(spark, d):
    """first success or last error per delivery."""
    classified = outcomes.classify_responses(b.attempts(spark, d))
    return outcomes.resolve_attempts(classified, 3)


@query
def retry_schedule(spark, d):
    """due times after a failed first attempt."""
    first = b.attempts(spark, d).where((F.col("attempt") == 0) & ~F.col("ok"))
    kept = first.select("idempotency_key", "attempted_at")
    return outcomes.retry_schedule(kept, Retries(times=6))


@query
def circuit_history(spark, d):
    """circuit state before every attempt."""
    policy = Breaker(limit=5, rest_seconds=3600.0)
    return circuit.circuit_history(b.attempts(spark, d), policy)


@query
def circuit_now(spark, d):
    """circuit state per endpoint at one instant."""
    as_of = F.lit(AS_OF).cast("timestamp")
    return circuit.circuit_state(b.attempts(spark, d), as_of, GATE_POLICY)


@query
def gated_keys(spark, d):
    """new keys an open circuit dead-letters at once."""
    plan = _classified(spark, d).withColumn("planned_at", F.lit(AS_OF).cast("timestamp"))
    return outcomes.gated_outcomes(plan).select(
        *KEY, "status", "error_message", "retry_count", "attempts_made"
    )


@query
def dead_letter_selection(spark, d):
    """exhausted deliveries."""
    classified = outcomes.classify_responses(b.attempts(spark, d))
    resolved = outcomes.resolve_attempts(classified, 3)
    return outcomes.dead_letter_outcomes(resolved).select(
        *KEY, "error_message", "retry_count", "attempts_made"
    )


# --- reports --------------------------------------------------------------------------


@query
def batch_summary(spark, d):
    """G1: counts of one batch; the attempts' outcomes and the classified batch."""
    classified = outcomes.classify_responses(b.attempts(spark, d))
    resolved = outcomes.resolve_attempts(classified, 3)
    planned = dedup.classify(dedup.fold_batch(b.batch(spark, d)), _delivered(spark, d))
    return reports.batch_summary(resolved, planned)


@query
def ledger_duplicates(spark, d):
    """G2."""
    return reports.duplicate_keys(b.ledger_events(spark, d))


@query
def validation_summary(spark, d):
    """G3, T5."""
    letters = b.dead_letter_events(spark, d).where(F.col("event") == "dead_lettered")
    return reports.validation_summary(b.obs_queue(spark, d), b.ledger_events(spark, d), letters)


@query
def status_breakdown(spark, d):
    """G4."""
    return reports.status_counts(ledger.current_ledger(b.ledger_events(spark, d)))


@query
def latest_ledger_rows(spark, d):
    """G5."""
    rows = reports.latest(b.ledger_events(spark, d), "attempted_at", "idempotency_key", "seq")
    return rows.select(*KEY, "status", "attempted_at", "seq")


@query
def latest_dead_letters(spark, d):
    """G6."""
    letters = b.dead_letter_events(spark, d).where(F.col("event") == "dead_lettered")
    rows = reports.latest(letters, "event_at", "idempotency_key", "seq")
    return rows.select(*KEY, "last_error", "event_at", "seq")


@query
def ordered_ledger(spark, d):
    """The whole ledger by time."""
    rows = b.ledger_events(spark, d).orderBy("attempted_at", "seq")
    return rows.select("idempotency_key", "status", "attempted_at", "seq")


@query
def ordered_queue(spark, d):
    """The whole queue by patient."""
    rows = b.obs_queue(spark, d).orderBy("patient_id", "event_id")
    return rows.select("patient_id", "event_id", "observation_code")


@query
def risk_distribution(spark, d):
    """G8."""
    return cohort.risk_distribution(cohort.score_cohort(b.measurements(spark, d)))


@query
def first_written(spark, d):
    """G9."""
    return reports.first_written(_resolved(spark, d))


@query
def latest_of_code(spark, d):
    """Newest rows of one code (ties by patient)."""
    scored = cohort.score_observations(cohort.score_cohort(b.measurements(spark, d)))
    newest = reports.latest_of_code(normalize.to_observations(scored), cohort.RISK_CODE)
    return newest.select("patient_id", "code", "value_str", "effective_datetime")


# --- clinical scoring -----------------------------------------------------------------


def _scores(spark: SparkSession, d: str) -> DataFrame:
    return cohort.score_cohort(b.measurements(spark, d))


@query
def sirs_scores(spark, d):
    """S1, S2."""
    return _scores(spark, d).select(
        "event_id", "sirs_score", F.array_join("sirs_criteria", ", ").alias("criteria")
    )


@query
def qsofa_scores(spark, d):
    """S3, S4."""
    return _scores(spark, d).select(
        "event_id", "qsofa_score", F.array_join("qsofa_criteria", ", ").alias("criteria")
    )


@query
def cohort_scores(spark, d):
    """S5, S6, S7."""
    return _scores(spark, d).select(
        "event_id", "patient_id", "sirs_score", "qsofa_score", "lactate", "risk_level", "summary"
    )


@query
def score_observations(spark, d):
    """Two observations per score."""
    return cohort.score_observations(_scores(spark, d)).select(
        "patient_id",
        "observation_code",
        "display_name",
        "value",
        "value_str",
        "unit",
        "metadata_json",
        "effective_datetime",
    )


# --- streaming and jobs ---------------------------------------------------------------


def new_workspace(spark: SparkSession) -> Workspace:
    workspace = Workspace(f"{shared_dir(spark)}/workspace-{uuid.uuid4().hex}")
    ensure_tables(spark, workspace)
    return workspace


def _queued_workspace(spark: SparkSession, d: str) -> Workspace:
    """A workspace whose queue holds the queue view: numbers, texts, booleans and metadata."""
    workspace = new_workspace(spark)
    rows = b.obs_queue(spark, d).select(*QUEUE.fieldNames())
    rows.write.mode("append").parquet(workspace.path("observations_queue"))
    refresh_ready(spark, workspace, F.col("effective_datetime"))
    return workspace


def _endpoint(first_attempt: int = 0) -> Endpoint:
    return Endpoint(
        "generic_fhir",
        "fhir",
        "https://fhir.example",
        scripted_transport(first_attempt),
        circuit=None,
        sleep=_no_wait,
    )


@query
def ready_stream(spark, d):
    """The triggered stream's ready table."""
    workspace = _queued_workspace(spark, d)
    return read_table(spark, workspace, "observations_ready").drop("queued_date")


@query
def delivery_job(spark, d):
    """One batch over the ready table."""
    workspace = _queued_workspace(spark, d)
    return run_delivery_batch(spark, workspace, _endpoint(), "b1", limit=None).drop(
        "batch_id", "finished_at"
    )


@query
def flowsheet_job(spark, d):
    """One batch over the flowsheet route, whose answers hold no id."""
    workspace = _queued_workspace(spark, d)
    target = replace(_endpoint(), ehr_system="epic", api="flowsheet")
    run_delivery_batch(spark, workspace, target, "b1", limit=None)
    rows = ledger.current_ledger(read_table(spark, workspace, "delivery_ledger"))
    return rows.select(*KEY, "patient_id", "status", "ehr_resource_id", "error_message")


@query
def two_system_report(spark, d):
    """One queue sent to two systems; one observation is two deliveries, no duplicate."""
    workspace = _queued_workspace(spark, d)
    run_delivery_batch(spark, workspace, _endpoint(), "b1", limit=None)
    other = replace(_endpoint(), ehr_system="cerner")
    run_delivery_batch(spark, workspace, other, "b2", limit=None)
    return validate_run(spark, workspace)["summary"]


@query
def limited_batch(spark, d):
    """The 25 oldest keys; what stays over is left for the next batch."""
    workspace = _queued_workspace(spark, d)
    run_delivery_batch(spark, workspace, _endpoint(), "b1", limit=25)
    rows = read_table(spark, workspace, "delivery_ledger")
    return rows.select(*KEY, "patient_id", "observation_code", "status", "retry_count")


@query
def quarantined_inputs(spark, d):
    """What two batches over one ready table put aside, each row once."""
    workspace = _queued_workspace(spark, d)
    for batch_id in ("b1", "b2"):
        run_delivery_batch(spark, workspace, _endpoint(), batch_id, limit=None)
    rows = read_table(spark, workspace, "quarantine")
    return rows.groupBy("batch_id", "failed_rules").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def score_delivery_job(spark, d):
    """Scores of a cohort with gaps; each measurement is sent or put aside."""
    e = F.col("event_id")
    measured = b.measurements(spark, d).withColumns(
        {
            "measured_at": F.when(e % 53 != 0, F.col("measured_at")),
            "lactate": F.when(e % 47 != 0, F.col("lactate")),
        }
    )
    workspace = new_workspace(spark)
    known = b.patient_map(spark, d)
    summary = score_and_deliver(spark, workspace, measured, known, _endpoint(), "s1")
    return summary.drop("batch_id", "finished_at")


@query
def circuit_job(spark, d):
    """A dead endpoint opens the circuit of all tasks, the next batch is gated
    whole, and after the rest all of it is delivered."""
    workspace = _queued_workspace(spark, d)
    dead = replace(
        _endpoint(),
        open_transport=scripted_answer(503),
        circuit=Breaker(rest_seconds=86_400.0, shared=True),
        max_concurrency=2,
    )
    rested = replace(dead, open_transport=scripted_answer(201), circuit=Breaker(rest_seconds=0.0))
    for batch_id, target in (("b1", dead), ("b2", dead), ("b3", rested)):
        run_delivery_batch(spark, workspace, target, batch_id, limit=None)
    counts = read_table(spark, workspace, "attempt_log").groupBy("batch_id").agg(
        F.count_if(~F.col("gated")).alias("n_requests")
    )
    rows = read_table(spark, workspace, "delivery_ledger").groupBy("batch_id").agg(
        F.count_if(F.col("error_message") == outcomes.CIRCUIT_OPEN).alias("n_gated"),
        F.count_if(F.col("status") == "success").alias("succeeded"),
        F.count_if(F.col("status") == "dead_lettered").alias("dead_lettered"),
    )
    return rows.join(counts, "batch_id", "left").fillna(0, ["n_requests"])


@query
def patient_create_job(spark, d):
    """Patients the map does not hold, created through the endpoint in two batches.

    The second batch asks again for those who failed; the endpoint refuses them again.
    """
    workspace = new_workspace(spark)
    endpoint = replace(_endpoint(), open_transport=scripted_patients())
    registered = b.patient_map(spark, d).withColumns(
        {
            "endpoint": F.lit(endpoint.base_url),
            "status": F.lit(patients.KNOWN),
            "error_message": F.lit(None),
            "attempted_at": F.lit(None),
        }
    )
    replace_batch(registered, workspace, "patient_links", batch_id="seed")
    for batch_id in ("p1", "p2"):
        register_patients(spark, workspace, b.patients(spark, d), endpoint, batch_id)
    links = read_table(spark, workspace, "patient_links").where("batch_id <> 'seed'")
    return links.select("batch_id", "patient_id", "status", "endpoint_patient_id", "error_message")


@query
def delivery_rerun(spark, d):
    """A second batch sends only what has not succeeded; no key is added."""
    workspace = _queued_workspace(spark, d)
    reruns = []
    for batch_id in ("b1", "b2"):
        summary = run_delivery_batch(spark, workspace, _endpoint(), batch_id, limit=None)
        keys = ledger.current_ledger(read_table(spark, workspace, "delivery_ledger")).agg(
            F.count_distinct(*KEY).alias("distinct_keys")
        )
        # Stored, because the ledger changes with the next batch.
        path = workspace.path(f"reports/{batch_id}")
        keys.withColumn("batch_id", F.lit(batch_id)).write.parquet(path)
        reruns.append(spark.read.parquet(path).join(summary, "batch_id").drop("finished_at"))
    return reruns[0].unionByName(reruns[1])


@query
def reprocess_job(spark, d):
    """T4: letters after one batch and one reprocessing run."""
    workspace = _queued_workspace(spark, d)
    run_delivery_batch(spark, workspace, _endpoint(), "b1", limit=None)
    again = reprocess_endpoint(_endpoint(first_attempt=3))
    reprocess_dead_letters(spark, workspace, again, "b2", limit=None)
    states = dead_letters.letter_states(read_table(spark, workspace, "dead_letters"))
    return states.select(
        *KEY, "patient_id", "observation_code", "last_error", "retry_count", "reprocessed"
    )


@query
def validation_job(spark, d):
    """T5: the validation summary after a delivery batch."""
    workspace = _queued_workspace(spark, d)
    run_delivery_batch(spark, workspace, _endpoint(), "b1", limit=None)
    return validate_run(spark, workspace)["summary"]
