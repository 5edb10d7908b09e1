"""Queue, log and ledger views derived from the supplied tables.

The tables hold no clinical data, so each view maps one of them row by row:
``events`` becomes the observation queue, the attempts and the measurements,
``customer`` and ``part`` become patients.  Nulls, empty texts, failures and
repeats follow integer rules on ``event_id``, so that SQL can state them too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartpost.functions.keys import idempotency_key
from chartpost.functions.values import observation_json
from chartpost.operators.expectations import delivery_rules, keep_valid
from chartpost.operators.normalize import to_observations, with_key
from chartpost.schemas import DEAD_LETTERED, LOINC, REPROCESSED, SUCCESS


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One supplied table; its zone-less times are UTC instants."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    local = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({name: F.col(name).cast("timestamp") for name in local})


def obs_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue rows: one per event, effective on the event's day (so keys repeat)."""
    return load(spark, sf_dir, "events").selectExpr(
        "event_id",
        "user_id",
        "CASE WHEN event_id % 97 <> 0 THEN concat('P', user_id) END AS patient_id",
        "CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 7 = 0 THEN '' "
        "ELSE concat('E', event_id % 1000) END AS encounter_id",
        "CASE WHEN event_id % 89 <> 0 THEN event_type END AS observation_code",
        "CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' "
        f"ELSE '{LOINC}' END AS code_system",
        "CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' "
        "ELSE upper(event_type) END AS display_name",
        "CASE WHEN event_id % 101 <> 0 AND event_id % 13 <> 2 THEN value END AS value",
        "CASE WHEN event_id % 13 = 2 THEN concat('grade-', event_id % 4) END AS value_str",
        "CASE WHEN event_id % 11 = 1 THEN event_id % 2 = 0 END AS value_bool",
        "CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '%' "
        "ELSE 'mmHg' END AS unit",
        "date_trunc('day', ts) AS effective_datetime",
        "CASE event_id % 8 WHEN 0 THEN NULL WHEN 1 THEN '' "
        "ELSE concat('feed-', event_id % 3) END AS source_system",
        "CASE WHEN event_id % 10 = 0 "
        """THEN concat('{"flowsheet_template_id":"T-', event_id % 7, '"}') """
        "ELSE props END AS metadata_json",
        "ts AS queued_at",
    )


# Each user belongs to one of the four routes and one of forty sites.
ROUTED = (
    "CASE user_id % 4 WHEN 0 THEN 'generic_fhir' WHEN 2 THEN 'cerner' ELSE 'epic' END "
    "AS ehr_system",
    "CASE user_id % 4 WHEN 3 THEN 'flowsheet' ELSE 'fhir' END AS api",
    "concat('site-', user_id % 40) AS endpoint",
)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliverable rows, normalised and keyed."""
    queue = obs_queue(spark, sf_dir)
    valid = keep_valid(queue, delivery_rules(queue.columns))
    return with_key(to_observations(valid.selectExpr("*", *ROUTED)))


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed observations as one delivery batch."""
    return observations(spark, sf_dir)


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts 0..3 per event up to the first success, one key per exact instant."""
    # Seconds since the first attempt; an attempt is made while all earlier ones failed.
    steps = "posexplode(array(0, 1, 3, 7)) AS (attempt, elapsed)"
    ok = "(event_id % 11 <> 0 AND (event_id * 31 + {} * 17) % 10 < 6)"
    earlier = " OR ".join(f"(attempt > {n} AND {ok.format(n)})" for n in range(3))
    events = load(spark, sf_dir, "events").withColumn(
        "idempotency_key",
        idempotency_key(F.concat(F.lit("P"), F.col("user_id")), F.col("event_type"), F.col("ts")),
    )
    return (
        events.selectExpr("event_id", "ts", "idempotency_key", *ROUTED, steps)
        .where(f"NOT ({earlier})")
        .selectExpr("*", f"{ok.format('attempt')} AS ok", "(event_id + attempt) % 5 AS kind")
        .selectExpr(
            "event_id",
            "idempotency_key",
            "ehr_system",
            "api",
            "endpoint",
            "attempt",
            "event_id * 4 + attempt AS seq",
            "timestampadd(SECOND, elapsed, ts) AS attempted_at",
            "CASE WHEN ok THEN IF(event_id % 2 = 0, 201, 200) ELSE "
            "CASE kind WHEN 0 THEN 400 WHEN 1 THEN 429 WHEN 2 THEN 500 WHEN 3 THEN 503 END "
            "END AS http_status",
            """CASE WHEN ok THEN concat('{"id":"r-', event_id, '"}') """
            "WHEN kind <> 4 THEN concat('refused ', event_id % 7) END AS body",
            "CASE WHEN NOT ok AND kind = 4 THEN 'timed out' END AS transport_error",
            "ok",
            "false AS gated",
            "to_date(ts) AS effective_date",
        )
    )


def ledger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger history: of every four events one succeeded and one was dead-lettered."""
    won = "event_id % 4 = 0"
    return (
        observations(spark, sf_dir)
        .where("event_id % 4 < 2")
        .selectExpr(
            "idempotency_key",
            "patient_id",
            "code AS observation_code",
            "ehr_system",
            "api",
            f"CASE WHEN {won} THEN concat('r-', event_id) END AS ehr_resource_id",
            f"CASE WHEN {won} THEN '{SUCCESS}' ELSE '{DEAD_LETTERED}' END AS status",
            "queued_at AS attempted_at",
            f"CASE WHEN NOT {won} THEN concat('HTTP 503: refused ', event_id % 7) END "
            "AS error_message",
            f"CAST(CASE WHEN {won} THEN event_id % 3 ELSE 3 END AS INT) AS retry_count",
            "event_id AS seq",
            "'seed' AS batch_id",
            "effective_date",
        )
    )


def dead_letter_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letters (some with broken JSON) and, for every third of them, a later mark."""
    letters = observations(spark, sf_dir).where("event_id % 4 = 1")
    kinds = (
        f"IF(event_id % 12 = 5, array('{DEAD_LETTERED}', '{REPROCESSED}'), "
        f"array('{DEAD_LETTERED}'))"
    )
    return (
        letters.withColumn("observation_json", observation_json())
        .selectExpr("*", f"explode({kinds}) AS event")
        .selectExpr(
            "event",
            "idempotency_key",
            "patient_id",
            "code AS observation_code",
            "ehr_system",
            "api",
            "IF(event_id % 52 = 1, '{broken', observation_json) AS observation_json",
            "concat('HTTP 503: refused ', event_id % 7) AS last_error",
            "3 AS retry_count",
            "4 AS attempts_made",
            f"IF(event = '{REPROCESSED}', timestampadd(HOUR, 1, queued_at), queued_at) "
            "AS event_at",
            "event_id AS seq",
            "'seed' AS batch_id",
            "to_date(queued_at) AS event_date",
        )
    )


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers (names without a space) and parts (names with several words)."""
    customers = load(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey")).alias("patient_id"),
        F.col("c_name").alias("name"),
    )
    parts = load(spark, sf_dir, "part").select(
        F.concat(F.lit("Q"), F.col("p_partkey")).alias("patient_id"),
        F.col("p_name").alias("name"),
    )
    return customers.unionByName(parts)


def patient_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two customers of three are registered at the endpoint."""
    return (
        load(spark, sf_dir, "customer")
        .where(F.col("c_custkey") % 3 != 0)
        .select(
            F.concat(F.lit("C"), F.col("c_custkey")).alias("patient_id"),
            F.concat(F.lit("fhir-"), F.col("c_custkey")).alias("endpoint_patient_id"),
        )
    )


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One set of vitals and labs per event."""

    def tenths(rule: str, name: str) -> str:
        return f"CAST({rule} AS DOUBLE) / 10e0 AS {name}"

    def integer(rule: str, name: str) -> str:
        return f"CAST({rule} AS INT) AS {name}"

    return load(spark, sf_dir, "events").selectExpr(
        "event_id",
        "concat('C', user_id) AS patient_id",
        "concat('Patient ', user_id) AS name",
        integer("20 + event_id % 70", "age"),
        tenths("350 + event_id * 7 % 60", "temperature_c"),
        integer("60 + event_id * 13 % 80", "heart_rate"),
        integer("14 + event_id * 3 % 20", "respiratory_rate"),
        integer("80 + event_id * 11 % 60", "systolic_bp"),
        integer("50 + event_id % 40", "diastolic_bp"),
        tenths("880 + event_id % 120", "spo2"),
        tenths("30 + (event_id div 7) * 11 % 120", "wbc_count"),
        tenths("5 + (event_id div 3) * 13 % 60", "lactate"),
        tenths("5 + event_id % 30", "creatinine"),
        integer("100 + event_id % 300", "platelet_count"),
        "ts AS measured_at",
    )
