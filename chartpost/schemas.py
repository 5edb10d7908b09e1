"""Explicit schemas of every table the jobs read or write."""

from __future__ import annotations

from pyspark.sql import types as T

# Coding systems, defaults and state names.
LOINC = "http://loinc.org"
UCUM = "http://unitsofmeasure.org"
DEFAULT_SOURCE = "spark-analytics"

SUCCESS = "success"
FAILED = "failed"
DEAD_LETTERED = "dead_lettered"
REPROCESSED = "reprocessed"

# What identifies one delivery: the same observation may go to two systems.
DELIVERY_KEY = ("idempotency_key", "ehr_system", "api")


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}


def _schema(columns: str) -> T.StructType:
    """Schema of ``name TYPE`` pairs; needs no session, as executors import this too."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


QUEUE = _schema(
    """patient_id STRING, encounter_id STRING, observation_code STRING, code_system STRING,
    display_name STRING, value DOUBLE, value_str STRING, value_bool BOOLEAN, unit STRING,
    effective_datetime TIMESTAMP, source_system STRING, metadata_json STRING"""
)

READY = _schema(
    """patient_id STRING, encounter_id STRING, observation_code STRING, code_system STRING,
    display_name STRING, value DOUBLE, value_str STRING, value_bool BOOLEAN, unit STRING,
    effective_datetime TIMESTAMP, source_system STRING, metadata_json STRING,
    queued_at TIMESTAMP, queued_date DATE"""
)

OBSERVATION = _schema(
    """patient_id STRING, encounter_id STRING, code STRING, code_system STRING,
    display_name STRING, value_type STRING, value_num DOUBLE, value_str STRING,
    value_bool BOOLEAN, unit STRING, effective_datetime TIMESTAMP, source_system STRING,
    metadata_json STRING"""
)

ATTEMPT_LOG = _schema(
    """idempotency_key STRING, ehr_system STRING, api STRING, endpoint STRING, attempt INT,
    seq BIGINT, attempted_at TIMESTAMP, http_status INT, body STRING, transport_error STRING,
    ok BOOLEAN, gated BOOLEAN, effective_date DATE, batch_id STRING, wave INT"""
)

LEDGER = _schema(
    """idempotency_key STRING, patient_id STRING, observation_code STRING, ehr_system STRING,
    api STRING, ehr_resource_id STRING, status STRING, attempted_at TIMESTAMP,
    error_message STRING, retry_count INT, seq BIGINT, batch_id STRING, effective_date DATE"""
)

DEAD_LETTER_EVENTS = _schema(
    """event STRING, idempotency_key STRING, patient_id STRING, observation_code STRING,
    ehr_system STRING, api STRING, observation_json STRING, last_error STRING, retry_count INT,
    attempts_made INT, event_at TIMESTAMP, seq BIGINT, batch_id STRING, event_date DATE"""
)

PATIENT_MEASUREMENTS = _schema(
    """patient_id STRING, name STRING, age INT, temperature_c DOUBLE, heart_rate INT,
    respiratory_rate INT, systolic_bp INT, diastolic_bp INT, spo2 DOUBLE, wbc_count DOUBLE,
    lactate DOUBLE, creatinine DOUBLE, platelet_count INT, measured_at TIMESTAMP"""
)

BATCHES = _schema(
    """batch_id STRING, succeeded BIGINT, skipped BIGINT, failed BIGINT, dead_lettered BIGINT,
    total BIGINT, success_rate DOUBLE, quarantined BIGINT, finished_at TIMESTAMP"""
)

CIRCUIT_SNAPSHOTS = _schema(
    """endpoint STRING, failures BIGINT, last_failure_at TIMESTAMP, taken_at TIMESTAMP,
    batch_id STRING"""
)

# Answers to patient creates: one row per patient and batch, the id only where there is one.
PATIENT_LINKS = _schema(
    """patient_id STRING, endpoint STRING, endpoint_patient_id STRING, status STRING,
    error_message STRING, attempted_at TIMESTAMP, batch_id STRING"""
)

# What an endpoint's batches have read of the ready table: visible and deliverable rows per
# date, and the keys of each date that were not delivered when the batch was planned.
READY_DATES = _schema(
    """ehr_system STRING, api STRING, queued_date DATE, n_rows BIGINT, n_valid BIGINT,
    taken_at TIMESTAMP, batch_id STRING"""
)

BACKLOG = _schema(
    """idempotency_key STRING, ehr_system STRING, api STRING, queued_date DATE,
    occurrences BIGINT, queued_at TIMESTAMP, effective_datetime TIMESTAMP, effective_date DATE,
    batch_id STRING"""
)

# What an endpoint's reprocessing has read of the letters: rows per partition, and the keys
# still pending then, each with the place of its latest letter.
LETTER_PARTS = _schema(
    """ehr_system STRING, api STRING, letter_batch STRING, event STRING, n_rows BIGINT,
    taken_at TIMESTAMP, batch_id STRING"""
)

PENDING_KEYS = _schema(
    """idempotency_key STRING, ehr_system STRING, api STRING, dead_lettered_at TIMESTAMP,
    seq BIGINT, letter_batch STRING, readable BOOLEAN, effective_datetime TIMESTAMP,
    batch_id STRING"""
)

# Inputs that cannot be delivered, whatever their columns: row_json holds all of them.
QUARANTINE = _schema(
    """patient_id STRING, observation_code STRING, effective_datetime TIMESTAMP,
    queued_at TIMESTAMP, failed_rules STRING, row_json STRING, row_hash BIGINT, batch_id STRING"""
)

# table -> (schema, partition columns)
TABLES = {
    "observations_queue": (QUEUE, ()),
    "observations_ready": (READY, ("queued_date",)),
    "attempt_log": (ATTEMPT_LOG, ("batch_id", "wave")),
    "delivery_ledger": (LEDGER, ("batch_id", "effective_date")),
    "dead_letters": (DEAD_LETTER_EVENTS, ("batch_id", "event")),
    "delivery_batches": (BATCHES, ("batch_id",)),
    "circuit_snapshots": (CIRCUIT_SNAPSHOTS, ("batch_id",)),
    "quarantine": (QUARANTINE, ("batch_id",)),
    "patient_links": (PATIENT_LINKS, ("batch_id",)),
    "ready_dates": (READY_DATES, ("batch_id",)),
    "backlog": (BACKLOG, ("batch_id",)),
    "letter_parts": (LETTER_PARTS, ("batch_id",)),
    "pending_keys": (PENDING_KEYS, ("batch_id",)),
}
