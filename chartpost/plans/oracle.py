"""SQL statements the registered queries must equal, written for the supplied tables.

The views below restate the bindings in SQL; every statement then spells its
operator out on its own, without sharing anything with the Spark code.
"""

from __future__ import annotations

KEY = "idempotency_key, ehr_system, api"

# name -> (views it needs, select)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "queue": (
        (),
        """
        SELECT event_id, user_id,
          CASE WHEN event_id % 97 <> 0 THEN 'P' || user_id END AS patient_id,
          CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 7 = 0 THEN ''
               ELSE 'E' || (event_id % 1000) END AS encounter_id,
          CASE WHEN event_id % 89 <> 0 THEN event_type END AS observation_code,
          CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'http://loinc.org' END
            AS code_system,
          CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE upper(event_type) END
            AS display_name,
          CASE WHEN event_id % 101 <> 0 AND event_id % 13 <> 2 THEN value END AS value,
          CASE WHEN event_id % 13 = 2 THEN 'grade-' || (event_id % 4) END AS value_str,
          CASE WHEN event_id % 11 = 1 THEN event_id % 2 = 0 END AS value_bool,
          CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '%' ELSE 'mmHg' END
            AS unit,
          date_trunc('day', ts)::TIMESTAMP AS effective_datetime,
          CASE event_id % 8 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'feed-' || (event_id % 3) END
            AS source_system,
          CASE WHEN event_id % 10 = 0
               THEN '{"flowsheet_template_id":"T-' || (event_id % 7) || '"}'
               ELSE props END AS metadata_json,
          ts AS queued_at
        FROM events
        """,
    ),
    "obs": (
        ("queue",),
        """
        SELECT event_id, user_id, patient_id, encounter_id, observation_code AS code,
          coalesce(nullif(code_system, ''), 'http://loinc.org') AS code_system,
          coalesce(nullif(display_name, ''), observation_code) AS display_name,
          CASE WHEN value_bool IS NOT NULL THEN 'boolean' WHEN value IS NOT NULL THEN 'number'
               ELSE 'string' END AS value_type,
          CASE WHEN value_bool IS NULL THEN value END AS value_num,
          CASE WHEN value_bool IS NULL AND value IS NULL THEN value_str END AS value_str,
          value_bool, unit, effective_datetime,
          coalesce(nullif(source_system, ''), 'spark-analytics') AS source_system,
          metadata_json, queued_at,
          sha256(patient_id || ':' || observation_code || ':'
            || strftime(effective_datetime, '%Y-%m-%dT%H:%M:%S') || '+00:00') AS idempotency_key,
          CASE user_id % 4 WHEN 0 THEN 'generic_fhir' WHEN 2 THEN 'cerner' ELSE 'epic' END
            AS ehr_system,
          CASE user_id % 4 WHEN 3 THEN 'flowsheet' ELSE 'fhir' END AS api,
          'site-' || (user_id % 40) AS endpoint
        FROM queue
        WHERE patient_id IS NOT NULL AND observation_code IS NOT NULL
          AND (value IS NOT NULL OR value_str IS NOT NULL OR value_bool IS NOT NULL)
        """,
    ),
    "routes": (
        (),
        """
        SELECT * FROM (VALUES
          ('generic_fhir', 'fhir', 'fhir:', '/Observation', 'application/fhir+json',
           'application/fhir+json', true),
          ('epic', 'fhir', '', '/Observation', 'application/fhir+json', NULL, true),
          ('cerner', 'fhir', 'cerner:', '/Observation', 'application/fhir+json',
           'application/fhir+json', true),
          ('epic', 'flowsheet', 'fs:',
           '/api/epic/2014/Clinical/Patient/ADDFLOWSHEETVALUE/FlowsheetValue',
           'application/json', NULL, false))
          AS r(ehr_system, api, key_prefix, path, content_type, accept, returns_id)
        """,
    ),
    "log": (
        (),
        """
        SELECT *,
          CASE WHEN ok THEN CASE WHEN event_id % 2 = 0 THEN 201 ELSE 200 END
               ELSE CASE kind WHEN 0 THEN 400 WHEN 1 THEN 429 WHEN 2 THEN 500 WHEN 3 THEN 503 END
          END AS http_status,
          CASE WHEN ok THEN '{"id":"r-' || event_id || '"}'
               WHEN kind <> 4 THEN 'refused ' || (event_id % 7) END AS body,
          CASE WHEN NOT ok AND kind = 4 THEN 'timed out' END AS transport_error,
          CASE WHEN ok THEN NULL
               WHEN kind = 4 THEN 'Connection error: timed out'
               ELSE 'HTTP ' || CASE kind WHEN 0 THEN 400 WHEN 1 THEN 429 WHEN 2 THEN 500
                                         ELSE 503 END || ': refused ' || (event_id % 7)
          END AS error_message,
          CASE WHEN ok AND api = 'fhir' THEN 'r-' || event_id END AS ehr_resource_id
        FROM (
          SELECT e.event_id, e.user_id, e.event_type, e.value, e.props, e.ts, a.attempt,
            sha256('P' || user_id || ':' || event_type || ':'
              || strftime(ts, '%Y-%m-%dT%H:%M:%S')
              || CASE WHEN microsecond(ts) % 1000000 = 0 THEN ''
                      ELSE strftime(ts, '.%f') END || '+00:00') AS idempotency_key,
            CASE user_id % 4 WHEN 0 THEN 'generic_fhir' WHEN 2 THEN 'cerner' ELSE 'epic' END
              AS ehr_system,
            CASE user_id % 4 WHEN 3 THEN 'flowsheet' ELSE 'fhir' END AS api,
            'site-' || (user_id % 40) AS endpoint,
            event_id * 4 + a.attempt AS seq,
            ts + to_seconds(CASE a.attempt WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 3 ELSE 7 END)
              AS attempted_at,
            (event_id + a.attempt) % 5 AS kind,
            event_id % 11 <> 0 AND (event_id * 31 + a.attempt * 17) % 10 < 6 AS ok
          FROM events e, (VALUES (0), (1), (2), (3)) AS a(attempt)
          WHERE event_id % 11 = 0 OR (
            (a.attempt < 1 OR (event_id * 31) % 10 >= 6)
            AND (a.attempt < 2 OR (event_id * 31 + 17) % 10 >= 6)
            AND (a.attempt < 3 OR (event_id * 31 + 34) % 10 >= 6))
        )
        """,
    ),
    "resolved": (
        ("log",),
        """
        SELECT idempotency_key, ehr_system, api, event_id, user_id, event_type, value, props, ts,
          CASE WHEN ok THEN 'success' ELSE 'dead_lettered' END AS status,
          ehr_resource_id, error_message,
          CASE WHEN ok THEN attempt ELSE 3 END AS retry_count,
          attempt + 1 AS attempts_made, attempted_at, seq
        FROM log
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY attempt DESC) = 1
        """,
    ),
    "ledger": (
        ("obs",),
        """
        SELECT idempotency_key, patient_id, code AS observation_code, ehr_system, api,
          CASE WHEN event_id % 4 = 0 THEN 'r-' || event_id END AS ehr_resource_id,
          CASE WHEN event_id % 4 = 0 THEN 'success' ELSE 'dead_lettered' END AS status,
          queued_at AS attempted_at,
          CASE WHEN event_id % 4 = 1 THEN 'HTTP 503: refused ' || (event_id % 7) END
            AS error_message,
          (CASE WHEN event_id % 4 = 0 THEN event_id % 3 ELSE 3 END)::INTEGER AS retry_count,
          event_id AS seq
        FROM obs WHERE event_id % 4 < 2
        """,
    ),
    "current": (
        ("ledger",),
        """
        SELECT * FROM ledger
        QUALIFY row_number() OVER (PARTITION BY idempotency_key, ehr_system, api
                                   ORDER BY attempted_at DESC, seq DESC) = 1
        """,
    ),
    "delivered": (
        ("current",),
        "SELECT idempotency_key, ehr_system, api FROM current WHERE status = 'success'",
    ),
    "folded": (
        ("obs",),
        """
        SELECT *, count(*) OVER (PARTITION BY idempotency_key, ehr_system, api) AS occurrences,
          row_number() OVER (PARTITION BY idempotency_key, ehr_system, api
            ORDER BY queued_at, source_system, event_id) AS pos
        FROM obs
        QUALIFY pos = 1
        """,
    ),
    "letters": (
        ("obs",),
        """
        SELECT 'dead_lettered' AS event, idempotency_key, ehr_system, api, patient_id,
          code AS observation_code, 'HTTP 503: refused ' || (event_id % 7) AS last_error,
          3 AS retry_count, queued_at AS event_at, event_id, event_id AS seq,
          encounter_id, code, code_system, display_name, value_type, value_num, value_str,
          value_bool, unit, effective_datetime, source_system
        FROM obs WHERE event_id % 4 = 1
        """,
    ),
    "marks": (
        ("obs",),
        """
        SELECT idempotency_key, ehr_system, api, max(queued_at + INTERVAL 1 HOUR) AS marked_at
        FROM obs WHERE event_id % 12 = 5 GROUP BY ALL
        """,
    ),
    "pending": (
        ("letters", "marks"),
        """
        SELECT l.* FROM letters l LEFT JOIN marks m USING (idempotency_key, ehr_system, api)
        WHERE marked_at IS NULL OR event_at > marked_at
        QUALIFY row_number() OVER (PARTITION BY l.idempotency_key, l.ehr_system, l.api
                                   ORDER BY event_at DESC, seq DESC) = 1
        """,
    ),
    "people": (
        (),
        """
        SELECT 'C' || c_custkey AS patient_id, c_name AS name FROM customer
        UNION ALL SELECT 'Q' || p_partkey, p_name FROM part
        """,
    ),
    "registered": (
        (),
        """
        SELECT 'C' || c_custkey AS patient_id, 'fhir-' || c_custkey AS endpoint_patient_id
        FROM customer WHERE c_custkey % 3 <> 0
        """,
    ),
    "vitals": (
        (),
        """
        SELECT event_id, 'C' || user_id AS patient_id, ts AS measured_at,
          (350 + event_id * 7 % 60)::DOUBLE / 10e0 AS temperature_c,
          (60 + event_id * 13 % 80)::INTEGER AS heart_rate,
          (14 + event_id * 3 % 20)::INTEGER AS respiratory_rate,
          (80 + event_id * 11 % 60)::INTEGER AS systolic_bp,
          (30 + event_id // 7 * 11 % 120)::DOUBLE / 10e0 AS wbc_count,
          (5 + event_id // 3 * 13 % 60)::DOUBLE / 10e0 AS lactate
        FROM events
        """,
    ),
    "scored": (
        ("vitals",),
        """
        SELECT *,
          concat_ws(', ',
            CASE WHEN temperature_c > 38 THEN 'Temperature ' || temperature_c || '°C (fever)'
                 WHEN temperature_c < 36 THEN 'Temperature ' || temperature_c
                   || '°C (hypothermia)' END,
            CASE WHEN heart_rate > 90 THEN 'Heart rate ' || heart_rate || ' bpm (tachycardia)' END,
            CASE WHEN respiratory_rate > 20 THEN 'Respiratory rate ' || respiratory_rate
                   || '/min (tachypnea)' END,
            CASE WHEN wbc_count > 12 THEN 'WBC ' || wbc_count || ' x10³/µL (leukocytosis)'
                 WHEN wbc_count < 4 THEN 'WBC ' || wbc_count || ' x10³/µL (leukopenia)' END)
            AS sirs_text,
          concat_ws(', ',
            CASE WHEN respiratory_rate >= 22 THEN 'Respiratory rate ' || respiratory_rate
                   || '/min (≥22)' END,
            CASE WHEN systolic_bp <= 100 THEN 'Systolic BP ' || systolic_bp || ' mmHg (≤100)' END)
            AS qsofa_text,
          (CASE WHEN temperature_c > 38 OR temperature_c < 36 THEN 1 ELSE 0 END
            + CASE WHEN heart_rate > 90 THEN 1 ELSE 0 END
            + CASE WHEN respiratory_rate > 20 THEN 1 ELSE 0 END
            + CASE WHEN wbc_count > 12 OR wbc_count < 4 THEN 1 ELSE 0 END) AS sirs_score,
          (CASE WHEN respiratory_rate >= 22 THEN 1 ELSE 0 END
            + CASE WHEN systolic_bp <= 100 THEN 1 ELSE 0 END) AS qsofa_score
        FROM vitals
        """,
    ),
    "levels": (
        ("scored",),
        """
        SELECT *,
          CASE WHEN sirs_score >= 3 AND lactate >= 4 THEN 'critical'
               WHEN sirs_score >= 2 AND (qsofa_score >= 2 OR lactate >= 2) THEN 'high'
               WHEN sirs_score >= 2 OR qsofa_score >= 1 OR lactate >= 2 THEN 'moderate'
               ELSE 'low' END AS risk_level,
          'SIRS ' || sirs_score || '/4, qSOFA ' || qsofa_score || '/2 | lactate ' || lactate
            || ' mmol/L'
            || CASE WHEN sirs_text <> '' THEN ' | SIRS criteria: ' || sirs_text ELSE '' END
            || CASE WHEN qsofa_text <> '' THEN ' | qSOFA criteria: ' || qsofa_text ELSE '' END
            AS summary
        FROM scored
        """,
    ),
    "score_obs": (
        ("levels",),
        """
        SELECT patient_id, 'sepsis-risk-score' AS observation_code,
          'Sepsis Risk Score (SIRS + qSOFA)' AS display_name, NULL::DOUBLE AS value,
          risk_level AS value_str, NULL::VARCHAR AS unit,
          '{"sirs_score":' || sirs_score || ',"qsofa_score":' || qsofa_score || ',"lactate":'
            || lactate || ',"summary":' || to_json(summary)::VARCHAR || '}' AS metadata_json,
          measured_at AS effective_datetime
        FROM levels
        UNION ALL
        SELECT patient_id, 'sirs-score', 'SIRS Score', sirs_score::DOUBLE, NULL, '{score}', '{}',
          measured_at
        FROM levels
        """,
    ),
    "fhir": (
        ("obs",),
        """
        SELECT *,
          '{"resourceType":"Observation","status":"final","category":[{"coding":[{"system":'
          || '"http://terminology.hl7.org/CodeSystem/observation-category","code":"survey",'
          || '"display":"Survey"}]}],"code":{"coding":[{"system":' || to_json(code_system)
          || ',"code":' || to_json(code) || ',"display":' || to_json(display_name)
          || '}],"text":' || to_json(display_name) || '},"subject":{"reference":'
          || to_json('Patient/' || patient_id) || '},"effectiveDateTime":"'
          || strftime(effective_datetime, '%Y-%m-%dT%H:%M:%S') || '+00:00"'
          || CASE WHEN coalesce(encounter_id, '') <> ''
                  THEN ',"encounter":{"reference":' || to_json('Encounter/' || encounter_id) || '}'
                  ELSE '' END
          || CASE value_type
               WHEN 'boolean' THEN ',"valueBoolean":' || value_bool
               WHEN 'number' THEN ',"valueQuantity":{"value":' || value_num || ',"unit":'
                 || to_json(coalesce(unit, '')) || ',"system":"http://unitsofmeasure.org"}'
               ELSE ',"valueString":' || to_json(value_str) END
          || '}' AS payload
        FROM obs
        """,
    ),
    "flowsheet": (
        ("obs",),
        """
        SELECT *,
          '{"PatientID":' || to_json(patient_id) || ',"PatientIDType":"FHIR","ContactID":'
          || to_json(coalesce(encounter_id, '')) || ',"ContactIDType":"CSN","FlowsheetRowID":'
          || to_json(code) || ',"FlowsheetRowIDType":"EXTERNAL","Value":'
          || to_json(CASE value_type WHEN 'boolean'
                       THEN CASE WHEN value_bool THEN 'True' ELSE 'False' END
                       WHEN 'number' THEN value_num::VARCHAR ELSE value_str END)
          || ',"InstantValueTaken":"' || strftime(effective_datetime, '%Y-%m-%dT%H:%M:%SZ')
          || '","FlowsheetTemplateID":'
          || to_json(coalesce(json_extract_string(metadata_json, '$.flowsheet_template_id'), ''))
          || '}' AS payload
        FROM obs
        """,
    ),
    "history": (
        ("log",),
        """
        SELECT *,
          coalesce(count(*) FILTER (NOT ok) OVER upto, 0) AS failures_before,
          max(attempted_at) FILTER (NOT ok) OVER upto AS last_failure_before
        FROM (
          SELECT endpoint, attempted_at, seq, ok,
            coalesce(count(*) FILTER (ok) OVER (PARTITION BY endpoint ORDER BY attempted_at, seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS grp
          FROM log)
        WINDOW upto AS (PARTITION BY endpoint, grp ORDER BY attempted_at, seq
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        """,
    ),
    "circuit": (
        ("log",),
        """
        SELECT endpoint, failures, last_failure_at,
          CASE WHEN failures < 2 THEN 'closed'
               WHEN last_failure_at > TIMESTAMP '2024-01-31' - INTERVAL 20 DAY THEN 'open'
               ELSE 'half_open' END AS state
        FROM (
          SELECT l.endpoint, count(*) FILTER (NOT ok AND (w.a IS NULL OR (l.attempted_at, l.seq) > (w.a, w.s)))
              AS failures,
            max(l.attempted_at) FILTER (NOT ok AND (w.a IS NULL OR (l.attempted_at, l.seq) > (w.a, w.s)))
              AS last_failure_at
          FROM log l LEFT JOIN (
            SELECT endpoint, attempted_at AS a, seq AS s FROM log WHERE ok
            QUALIFY row_number() OVER (PARTITION BY endpoint
                                       ORDER BY attempted_at DESC, seq DESC) = 1) w
            USING (endpoint)
          GROUP BY l.endpoint)
        """,
    ),
    "classified": (
        ("folded", "delivered", "circuit"),
        """
        SELECT f.*, CASE WHEN d.idempotency_key IS NOT NULL THEN 'already_delivered'
                         WHEN c.state = 'open' THEN 'gated' ELSE 'new' END AS outcome
        FROM folded f
        LEFT JOIN delivered d USING (idempotency_key, ehr_system, api)
        LEFT JOIN circuit c USING (endpoint)
        """,
    ),
    # The scripted endpoint: first accepted attempt per request id.
    "sendable": (
        ("queue",),
        """
        SELECT patient_id, observation_code AS code, effective_datetime,
          sha256(patient_id || ':' || observation_code || ':'
            || strftime(effective_datetime, '%Y-%m-%dT%H:%M:%S') || '+00:00') AS idempotency_key,
          count(*) AS occurrences,
          ('0x' || substr(sha256('fhir:' || patient_id || ':' || observation_code || ':'
            || strftime(effective_datetime, '%Y-%m-%dT%H:%M:%S') || '+00:00'), 1, 4))::INTEGER
            AS h
        FROM queue
        WHERE patient_id IS NOT NULL AND observation_code IS NOT NULL
          AND (value IS NOT NULL OR value_str IS NOT NULL OR value_bool IS NOT NULL)
        GROUP BY ALL
        """,
    ),
    # Ready rows without a value; their instant is always there.
    "unsendable": (
        ("queue",),
        """
        SELECT * FROM queue
        WHERE patient_id IS NOT NULL AND observation_code IS NOT NULL
          AND value IS NULL AND value_str IS NULL AND value_bool IS NULL
        """,
    ),
    # The scores of a cohort with gaps, one row per delivery key.
    "score_keys": (
        ("vitals", "registered"),
        """
        SELECT endpoint_patient_id AS patient_id, code, measured_at, count(*) AS occurrences,
          ('0x' || substr(sha256('fhir:' || endpoint_patient_id || ':' || code || ':'
            || CASE WHEN measured_at = date_trunc('second', measured_at)
                    THEN strftime(measured_at, '%Y-%m-%dT%H:%M:%S')
                    ELSE strftime(measured_at, '%Y-%m-%dT%H:%M:%S.%f') END
            || '+00:00'), 1, 4))::INTEGER AS h
        FROM vitals JOIN registered USING (patient_id),
          (VALUES ('sepsis-risk-score'), ('sirs-score')) AS c(code)
        WHERE event_id % 53 <> 0 AND event_id % 47 <> 0
        GROUP BY ALL
        """,
    ),
    "sent": (
        ("sendable",),
        """
        SELECT *, h % 11 <> 0 AND ((h * 31) % 10 < 6 OR (h * 31 + 17) % 10 < 6
                                   OR (h * 31 + 34) % 10 < 6) AS won,
          h % 11 <> 0 AND ((h * 31 + 51) % 10 < 6 OR (h * 31 + 68) % 10 < 6) AS won_later
        FROM sendable
        """,
    ),
}


def statement(views: str, body: str) -> str:
    """``body`` under the views it names, each with the views it needs in turn."""
    ordered: list[str] = []

    def need(name: str) -> None:
        if name not in ordered:
            for other in VIEWS[name][0]:
                need(other)
            ordered.append(name)

    for name in views.split():
        need(name)
    if not ordered:
        return body
    listed = ",\n".join(f'"{n}" AS ({VIEWS[n][1]})' for n in ordered)
    # A body with views of its own continues the list.
    own = body.startswith("WITH ")
    return f"WITH {listed}, {body[5:]}" if own else f"WITH {listed}\n{body}"


# query -> (views, statement)
_STATEMENTS: dict[str, tuple[str, str]] = {
    "next_ready_batch": (
        "folded delivered",
        f"""SELECT {KEY}, patient_id, code, queued_at
        FROM folded ANTI JOIN delivered USING ({KEY})
        ORDER BY queued_at, effective_datetime, {KEY} LIMIT 100""",
    ),
    "pending_dead_letters": (
        "pending",
        f"""SELECT {KEY}, patient_id, observation_code, last_error, retry_count,
          event_at AS dead_lettered_at
        FROM pending ORDER BY event_at, {KEY} LIMIT 100""",
    ),
    "demo_queue": (
        "",
        """SELECT 'DEMO-' || lpad(event_id::VARCHAR, greatest(3, length(event_id::VARCHAR))::INTEGER, '0')
            AS patient_id,
          'ENC-' || lpad(event_id::VARCHAR, greatest(3, length(event_id::VARCHAR))::INTEGER, '0')
            AS encounter_id,
          '8867-4' AS observation_code, 'http://loinc.org' AS code_system,
          'Heart rate' AS display_name, (event_id + 60)::DOUBLE AS value,
          'beats/minute' AS unit,
          TIMESTAMP '2026-03-21 12:00:00' + to_minutes(event_id) AS effective_datetime,
          'demo' AS source_system
        FROM events""",
    ),
    "ledger_current": (
        "current",
        f"""SELECT {KEY}, patient_id, observation_code, ehr_resource_id, status, attempted_at,
          error_message, retry_count FROM current""",
    ),
    "dead_letter_append": (
        "resolved",
        f"""SELECT 'dead_lettered' AS event, {KEY}, 'P' || user_id AS patient_id,
          event_type AS observation_code,
          '{{"patient_id":' || to_json('P' || user_id) || ',"encounter_id":null,"code":'
            || to_json(event_type) || ',"code_system":"http://loinc.org","display_name":'
            || to_json(event_type) || ',"value":' || value || ',"unit":"%","effective_datetime":"'
            || strftime(ts, '%Y-%m-%dT%H:%M:%S')
            || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END
            || 'Z","source_system":"feed","metadata":' || replace(props, ' ', '') || '}}'
            AS observation_json,
          error_message AS last_error, retry_count, attempted_at AS event_at
        FROM resolved WHERE status = 'dead_lettered'""",
    ),
    "dead_letter_states": (
        "letters marks",
        f"""SELECT {KEY}, patient_id, observation_code, last_error, event_at AS dead_lettered_at,
          coalesce(marked_at >= event_at, false) AS reprocessed
        FROM letters LEFT JOIN marks USING ({KEY})""",
    ),
    "ledger_append": (
        "resolved",
        f"""SELECT {KEY}, 'P' || user_id AS patient_id, event_type AS observation_code,
          ehr_resource_id, status, attempted_at, error_message, retry_count, seq FROM resolved""",
    ),
    "ledger_changes": (
        "ledger",
        f"""WITH p AS (
          SELECT *, lag(seq) OVER w AS prev_seq, lag(status) OVER w AS prev_status,
            lag(ehr_resource_id) OVER w AS prev_id, lag(retry_count) OVER w AS prev_retry
          FROM ledger WINDOW w AS (PARTITION BY {KEY} ORDER BY attempted_at, seq))
        SELECT CASE WHEN prev_seq IS NULL THEN 'insert' ELSE 'update_postimage' END AS change_type,
          attempted_at AS changed_at, {KEY}, status, ehr_resource_id, retry_count, seq FROM p
        UNION ALL
        SELECT 'update_preimage', attempted_at, {KEY}, prev_status, prev_id, prev_retry, prev_seq
        FROM p WHERE prev_seq IS NOT NULL""",
    ),
    "restored_letters": (
        "pending",
        f"""SELECT {KEY}, fine AS restored,
          CASE WHEN fine THEN patient_id END AS patient_id,
          CASE WHEN fine THEN encounter_id END AS encounter_id,
          CASE WHEN fine THEN code END AS code,
          CASE WHEN fine THEN code_system END AS code_system,
          CASE WHEN fine THEN value_type END AS value_type,
          CASE WHEN fine THEN value_num END AS value_num,
          CASE WHEN fine THEN value_str END AS value_str,
          CASE WHEN fine THEN value_bool END AS value_bool,
          CASE WHEN fine THEN unit END AS unit,
          CASE WHEN fine THEN effective_datetime END AS effective_datetime,
          CASE WHEN fine THEN source_system END AS source_system
        FROM (SELECT *, event_id % 52 <> 1 AS fine FROM pending)""",
    ),
    "delivery_attempts": (
        "folded routes",
        f"""WITH r AS (
          SELECT *, sha256(key_prefix || patient_id || ':' || code || ':'
            || strftime(effective_datetime, '%Y-%m-%dT%H:%M:%S') || '+00:00') AS rid
          FROM folded JOIN routes USING (ehr_system, api)),
        h AS (SELECT *, ('0x' || substr(rid, 1, 4))::INTEGER AS h FROM r),
        a AS (SELECT *, h % 11 <> 0 AND (h * 31 + attempt * 17) % 10 < 6 AS ok
              FROM h, (VALUES (0), (1), (2), (3)) AS t(attempt)),
        w AS (SELECT *, max(ok) OVER (PARTITION BY rid ORDER BY attempt
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS done FROM a)
        SELECT {KEY}, endpoint, attempt, CASE WHEN ok THEN 201 ELSE 503 END AS http_status,
          CASE WHEN ok THEN '{{"id":"r-' || substr(rid, 1, 12) || '"}}' ELSE 'busy ' || (h % 7) END
            AS body,
          ok, effective_datetime::DATE::VARCHAR AS effective_date
        FROM w WHERE NOT coalesce(done, false)""",
    ),
    "drop_missing_patient": (
        "queue",
        "SELECT event_id, patient_id, observation_code FROM queue WHERE patient_id IS NOT NULL",
    ),
    "drop_missing_code": (
        "queue",
        "SELECT event_id, patient_id, observation_code FROM queue "
        "WHERE observation_code IS NOT NULL",
    ),
    "expectation_counts": (
        "queue",
        """SELECT 'valid_patient' AS rule, count(patient_id) AS passed,
          count(*) - count(patient_id) AS failed FROM queue
        UNION ALL SELECT 'valid_code', count(observation_code),
          count(*) - count(observation_code) FROM queue
        UNION ALL SELECT 'valid_value', count(coalesce(value::VARCHAR, value_str, value_bool::VARCHAR)),
          count(*) - count(coalesce(value::VARCHAR, value_str, value_bool::VARCHAR)) FROM queue
        UNION ALL SELECT 'valid_effective', count(effective_datetime),
          count(*) - count(effective_datetime) FROM queue""",
    ),
    "quarantined_rows": (
        "queue",
        """SELECT event_id, concat_ws(',',
            CASE WHEN patient_id IS NULL THEN 'valid_patient' END,
            CASE WHEN observation_code IS NULL THEN 'valid_code' END,
            CASE WHEN value IS NULL AND value_str IS NULL AND value_bool IS NULL
                 THEN 'valid_value' END) AS failed_rules
        FROM queue
        WHERE patient_id IS NULL OR observation_code IS NULL
          OR (value IS NULL AND value_str IS NULL AND value_bool IS NULL)""",
    ),
    "ready_projection": (
        "queue",
        """SELECT patient_id, encounter_id, observation_code, code_system, display_name, value,
          value_str, value_bool, unit, effective_datetime, source_system, metadata_json, queued_at
        FROM queue WHERE patient_id IS NOT NULL AND observation_code IS NOT NULL""",
    ),
    "normalized_observations": (
        "obs",
        """SELECT event_id, patient_id, encounter_id, code, code_system, display_name, unit,
          effective_datetime, source_system, metadata_json FROM obs""",
    ),
    "value_dispatch": (
        "obs",
        "SELECT event_id, value_type, value_num, value_str, value_bool FROM obs",
    ),
    "success_lookup": ("delivered", f"SELECT {KEY} FROM delivered"),
    "route_resolution": (
        "obs routes",
        """SELECT event_id, ehr_system, api, key_prefix, path, content_type, accept, returns_id
        FROM obs JOIN routes USING (ehr_system, api)""",
    ),
    "default_keys": ("obs", "SELECT event_id, idempotency_key FROM obs"),
    "routed_keys": (
        "obs routes",
        """SELECT event_id, sha256(key_prefix || patient_id || ':' || code || ':'
            || strftime(effective_datetime, '%Y-%m-%dT%H:%M:%S') || '+00:00') AS request_id
        FROM obs JOIN routes USING (ehr_system, api)""",
    ),
    "instant_text": (
        "",
        """SELECT event_id,
          strftime(ts, '%Y-%m-%dT%H:%M:%S')
            || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END
            || '+00:00' AS iso_text,
          strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS iso_whole_text,
          strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS seconds_text
        FROM events""",
    ),
    "fhir_payloads": ("fhir", "SELECT event_id, payload FROM fhir"),
    "quantity_parts": (
        "obs",
        """SELECT event_id, '{"value":' || value_num || ',"unit":' || to_json(coalesce(unit, ''))
          || ',"system":"http://unitsofmeasure.org"}' AS quantity
        FROM obs WHERE value_type = 'number'""",
    ),
    "reference_texts": (
        "obs",
        """SELECT event_id, 'Patient/' || patient_id AS subject,
          'Encounter/' || nullif(encounter_id, '') AS encounter FROM obs""",
    ),
    "flowsheet_payloads": ("flowsheet", "SELECT event_id, payload FROM flowsheet"),
    "python_value_text": (
        "",
        """SELECT event_id, (value * CASE event_id % 10 WHEN 0 THEN 1e0 WHEN 1 THEN 1e6
            WHEN 2 THEN 1e9 WHEN 3 THEN 1e13 WHEN 4 THEN 1e14 WHEN 5 THEN 1e-3 WHEN 6 THEN 1e-5
            WHEN 7 THEN 1e-7 WHEN 8 THEN -1e0 ELSE 0e0 END + 0e0)::VARCHAR AS value_text
        FROM events""",
    ),
    "typed_value_text": (
        "obs",
        """SELECT event_id, CASE value_type WHEN 'boolean'
            THEN CASE WHEN value_bool THEN 'True' ELSE 'False' END
            WHEN 'number' THEN value_num::VARCHAR ELSE value_str END AS value_text
        FROM obs""",
    ),
    "metadata_lookup": (
        "obs",
        """SELECT event_id,
          coalesce(json_extract_string(metadata_json, '$.flowsheet_template_id'), '') AS template,
          coalesce(json_extract_string(metadata_json, '$.k'), 'none') AS k FROM obs""",
    ),
    "name_parts": (
        "people",
        """SELECT patient_id, split_part(name, ' ', 1) AS given,
          CASE WHEN contains(name, ' ') THEN substr(name, strpos(name, ' ') + 1)
               ELSE 'Unknown' END AS family FROM people""",
    ),
    "patient_payloads": (
        "people",
        """SELECT patient_id,
          '{"resourceType":"Patient","name":[{"family":'
            || to_json(CASE WHEN contains(name, ' ') THEN substr(name, strpos(name, ' ') + 1)
                            ELSE 'Unknown' END)
            || ',"given":[' || to_json(split_part(name, ' ', 1)) || ']}],"identifier":[{"system":'
            || '"urn:chartpost:patient","value":' || to_json(patient_id) || '}]}' AS payload,
          'identifier=urn:chartpost:patient|' || patient_id AS criterion
        FROM people""",
    ),
    "request_envelopes": (
        "folded fhir flowsheet routes",
        """SELECT f.idempotency_key, f.ehr_system, f.api, 'https://' || f.endpoint || path AS url,
          CASE WHEN accept IS NULL THEN '' ELSE 'Accept=' || accept || ';' END
            || 'Content-Type=' || content_type AS headers,
          sha256(key_prefix || f.patient_id || ':' || f.code || ':'
            || strftime(f.effective_datetime, '%Y-%m-%dT%H:%M:%S') || '+00:00') AS request_id,
          md5(CASE WHEN f.api = 'flowsheet' THEN s.payload ELSE p.payload END) AS body_md5
        FROM folded f JOIN routes USING (ehr_system, api)
          JOIN fhir p USING (event_id) JOIN flowsheet s USING (event_id)""",
    ),
    "resource_readback": (
        "obs",
        """SELECT 'r-' || event_id AS ehr_resource_id, 'Observation' AS resource_type,
          'final' AS status, code_system, code, display_name, patient_id,
          nullif(encounter_id, '') AS encounter_id,
          strftime(effective_datetime, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS effective_text,
          CASE WHEN value_type = 'number'
               THEN CASE WHEN event_id % 50 = 0 THEN value_num + 1e0 ELSE value_num END END
            AS value_num,
          CASE WHEN value_type = 'number' THEN coalesce(unit, '') END AS unit,
          value_str, value_bool
        FROM obs WHERE event_id % 10 <> 3""",
    ),
    "fahrenheit_values": (
        "vitals",
        "SELECT event_id, temperature_c * 9 / 5 + 32 AS temperature_f FROM vitals",
    ),
    "backoff_delays": (
        "log",
        """SELECT event_id, attempt, least(1e0 * pow(2e0, attempt), 30e0) AS delay_seconds,
          least(1e0 * pow(2e0, attempt + 3), 30e0) AS later_delay_seconds FROM log""",
    ),
    "error_texts": ("log", "SELECT event_id, attempt, error_message FROM log WHERE NOT ok"),
    "undelivered_observations": (
        "obs delivered",
        f"SELECT event_id, {KEY} FROM obs ANTI JOIN delivered USING ({KEY})",
    ),
    "skipped_keys": (
        "obs delivered",
        f"SELECT {KEY}, count(*) AS occurrences FROM obs SEMI JOIN delivered USING ({KEY}) "
        "GROUP BY ALL",
    ),
    "duplicate_rows": (
        "obs",
        f"""SELECT event_id, {KEY}, row_number() OVER (PARTITION BY {KEY}
          ORDER BY queued_at, source_system, event_id) = 1 AS is_winner FROM obs""",
    ),
    "folded_batch": ("folded", f"SELECT {KEY}, event_id, occurrences FROM folded"),
    "batch_classes": (
        "classified",
        f"""SELECT {KEY}, outcome,
          CASE WHEN outcome = 'already_delivered' THEN occurrences ELSE 1 END AS occurrences
        FROM classified
        UNION ALL
        SELECT {KEY}, 'duplicate_in_batch', occurrences - 1 FROM classified
        WHERE outcome <> 'already_delivered' AND occurrences > 1""",
    ),
    "patients_to_create": (
        "people registered",
        """SELECT patient_id, name,
          '{"resourceType":"Patient","name":[{"family":'
            || to_json(CASE WHEN contains(name, ' ') THEN substr(name, strpos(name, ' ') + 1)
                            ELSE 'Unknown' END)
            || ',"given":[' || to_json(split_part(name, ' ', 1)) || ']}],"identifier":[{"system":'
            || '"urn:chartpost:patient","value":' || to_json(patient_id) || '}]}' AS request_body,
          'identifier=urn:chartpost:patient|' || patient_id AS if_none_exist
        FROM people ANTI JOIN registered USING (patient_id)""",
    ),
    "mapped_patients": (
        "vitals registered",
        """SELECT event_id, endpoint_patient_id AS patient_id
        FROM vitals JOIN registered USING (patient_id)""",
    ),
    "unmapped_patients": (
        "vitals registered",
        """SELECT patient_id, count(*) AS n_rows
        FROM vitals ANTI JOIN registered USING (patient_id) GROUP BY patient_id""",
    ),
    "pairing_report": (
        "people vitals",
        """WITH l AS (SELECT patient_id, count(*) AS a FROM people GROUP BY 1),
        r AS (SELECT patient_id, count(*) AS b FROM vitals GROUP BY 1)
        SELECT count(*) FILTER (coalesce(a, 0) = coalesce(b, 0)) AS paired,
          count(*) FILTER (b IS NULL) AS without_score,
          count(*) FILTER (a IS NULL) AS without_patient,
          count(*) FILTER (a <> b) AS count_mismatch
        FROM l FULL JOIN r USING (patient_id)""",
    ),
    "readback_reconciliation": (
        "obs",
        """SELECT 'r-' || event_id AS ehr_resource_id,
          CASE WHEN event_id % 10 = 3 THEN 'not_stored'
               WHEN value_type = 'number' AND event_id % 50 = 0 THEN 'different'
               ELSE 'equal' END AS verdict,
          CASE WHEN event_id % 10 <> 3 AND value_type = 'number' AND event_id % 50 = 0
               THEN 'value_num' ELSE '' END AS differing_fields
        FROM obs WHERE event_id % 20 <> 7
        UNION ALL SELECT NULL, 'not_stored', '' FROM obs WHERE event_id % 20 = 7
        UNION ALL SELECT 'r-' || event_id, 'not_sent', '' FROM obs
        WHERE event_id % 20 = 7 AND event_id % 10 <> 3""",
    ),
    "all_observations": (
        "obs score_obs",
        """SELECT patient_id, code, display_name, value_type, value_num, value_str FROM obs
        UNION ALL
        SELECT patient_id, observation_code, display_name,
          CASE WHEN value IS NOT NULL THEN 'number' ELSE 'string' END, value, value_str
        FROM score_obs""",
    ),
    "response_classes": (
        "log",
        """SELECT event_id, attempt, CASE WHEN ok THEN 'success' ELSE 'failed' END AS status,
          ehr_resource_id, error_message FROM log""",
    ),
    "retry_resolution": (
        "resolved",
        f"""SELECT {KEY}, status, ehr_resource_id, error_message, retry_count, attempts_made,
          attempted_at, seq FROM resolved""",
    ),
    "retry_schedule": (
        "log",
        """SELECT idempotency_key, attempted_at, a AS attempt, d AS delay_seconds,
          c AS cumulative_seconds, attempted_at + to_microseconds((c * 1000000)::BIGINT)
            AS next_attempt_at
        FROM log, (VALUES (0, 1e0, 1e0), (1, 2e0, 3e0), (2, 4e0, 7e0), (3, 8e0, 15e0),
                          (4, 16e0, 31e0), (5, 30e0, 61e0)) AS s(a, d, c)
        WHERE attempt = 0 AND NOT ok""",
    ),
    "circuit_history": (
        "history",
        """SELECT endpoint, attempted_at, seq, ok, failures_before, last_failure_before,
          CASE WHEN failures_before < 5 THEN 'closed'
               WHEN attempted_at - last_failure_before < INTERVAL 1 HOUR THEN 'open'
               ELSE 'half_open' END AS state_before
        FROM history""",
    ),
    "circuit_now": ("circuit", "SELECT endpoint, failures, last_failure_at, state FROM circuit"),
    "gated_keys": (
        "classified",
        f"""SELECT {KEY}, 'dead_lettered' AS status, 'Circuit breaker open' AS error_message,
          0 AS retry_count, 0 AS attempts_made FROM classified WHERE outcome = 'gated'""",
    ),
    "dead_letter_selection": (
        "resolved",
        f"""SELECT {KEY}, error_message, retry_count, attempts_made FROM resolved
        WHERE status = 'dead_lettered'""",
    ),
    "batch_summary": (
        "resolved folded delivered",
        f"""SELECT succeeded, skipped, 0::BIGINT AS failed, dead_lettered,
          succeeded + skipped + dead_lettered AS total,
          succeeded::DOUBLE / (succeeded + skipped + dead_lettered) AS success_rate
        FROM (SELECT
          (SELECT count(*) FROM resolved WHERE status = 'success') AS succeeded,
          (SELECT count(*) FROM resolved WHERE status <> 'success') AS dead_lettered,
          (SELECT sum(CASE WHEN d.api IS NULL THEN occurrences - 1 ELSE occurrences END)::BIGINT
           FROM folded LEFT JOIN delivered d USING ({KEY})) AS skipped)""",
    ),
    "ledger_duplicates": (
        "ledger",
        f"""SELECT {KEY}, count(*) AS n_rows FROM ledger
        GROUP BY {KEY} HAVING count(*) > 1""",
    ),
    "validation_summary": (
        "queue ledger letters",
        """SELECT 'queued_observations' AS metric, count(*) AS n FROM queue
        UNION ALL SELECT 'log_rows', count(*) FROM ledger
        UNION ALL SELECT 'distinct_idempotency_keys', count(*) FROM
          (SELECT DISTINCT idempotency_key, ehr_system, api FROM ledger)
        UNION ALL SELECT 'duplicate_idempotency_keys', count(*) FROM
          (SELECT 1 FROM ledger GROUP BY idempotency_key, ehr_system, api HAVING count(*) > 1)
        UNION ALL SELECT 'dead_letter_rows', count(*) FROM letters""",
    ),
    "status_breakdown": (
        "current",
        "SELECT status, count(*) AS n_rows FROM current GROUP BY status ORDER BY status",
    ),
    "latest_ledger_rows": (
        "ledger",
        f"""SELECT {KEY}, status, attempted_at, seq FROM ledger
        ORDER BY attempted_at DESC, idempotency_key, seq LIMIT 20""",
    ),
    "latest_dead_letters": (
        "letters",
        f"""SELECT {KEY}, last_error, event_at, seq FROM letters
        ORDER BY event_at DESC, idempotency_key, seq LIMIT 20""",
    ),
    "ordered_ledger": (
        "ledger",
        """SELECT idempotency_key, status, attempted_at, seq FROM ledger
        ORDER BY attempted_at, seq""",
    ),
    "ordered_queue": (
        "queue",
        """SELECT patient_id, event_id, observation_code FROM queue
        ORDER BY patient_id NULLS FIRST, event_id""",
    ),
    "risk_distribution": (
        "levels",
        """SELECT l AS risk_level, count(risk_level) AS n_patients
        FROM (VALUES ('low'), ('moderate'), ('high'), ('critical')) AS t(l)
        LEFT JOIN levels ON risk_level = l GROUP BY l""",
    ),
    "first_written": (
        "resolved",
        """WITH won AS (SELECT *, row_number() OVER (ORDER BY attempted_at, seq) AS line
                     FROM resolved WHERE status = 'success')
        SELECT line::INTEGER AS line, ehr_resource_id, event_type AS display_name,
          0::BIGINT AS more FROM won WHERE line <= 5
        UNION ALL SELECT 6, NULL, NULL, count(*) - 5 FROM won HAVING count(*) > 5""",
    ),
    "latest_of_code": (
        "score_obs",
        """SELECT patient_id, observation_code AS code, value_str, effective_datetime
        FROM score_obs WHERE observation_code = 'sepsis-risk-score'
        ORDER BY effective_datetime DESC, patient_id LIMIT 20""",
    ),
    "sirs_scores": ("levels", "SELECT event_id, sirs_score, sirs_text AS criteria FROM levels"),
    "qsofa_scores": ("levels", "SELECT event_id, qsofa_score, qsofa_text AS criteria FROM levels"),
    "cohort_scores": (
        "levels",
        """SELECT event_id, patient_id, sirs_score, qsofa_score, lactate, risk_level, summary
        FROM levels""",
    ),
    "score_observations": ("score_obs", "SELECT * FROM score_obs"),
    "ready_stream": (
        "queue",
        """SELECT patient_id, encounter_id, observation_code, code_system, display_name, value,
          value_str, value_bool, unit, effective_datetime, source_system, metadata_json,
          effective_datetime AS queued_at
        FROM queue WHERE patient_id IS NOT NULL AND observation_code IS NOT NULL""",
    ),
    "delivery_job": (
        "sent unsendable",
        """SELECT succeeded, skipped, 0::BIGINT AS failed, dead_lettered,
          succeeded + skipped + dead_lettered AS total,
          succeeded::DOUBLE / (succeeded + skipped + dead_lettered) AS success_rate,
          (SELECT count(*) FROM unsendable) AS quarantined
        FROM (SELECT count(*) FILTER (won) AS succeeded,
          sum(occurrences - 1)::BIGINT AS skipped,
          count(*) FILTER (NOT won) AS dead_lettered FROM sent)""",
    ),
    "flowsheet_job": (
        "sendable",
        """SELECT idempotency_key, 'epic' AS ehr_system, 'flowsheet' AS api, patient_id,
          CASE WHEN won THEN 'success' ELSE 'dead_lettered' END AS status,
          NULL::VARCHAR AS ehr_resource_id,
          CASE WHEN NOT won THEN 'HTTP 503: busy ' || (h % 7) END AS error_message
        FROM (SELECT *, h % 11 <> 0 AND ((h * 31) % 10 < 6 OR (h * 31 + 17) % 10 < 6
                                         OR (h * 31 + 34) % 10 < 6) AS won
              FROM (SELECT * EXCLUDE h, ('0x' || substr(sha256('fs:' || patient_id || ':' || code
                      || ':' || strftime(effective_datetime, '%Y-%m-%dT%H:%M:%S') || '+00:00'),
                      1, 4))::INTEGER AS h FROM sendable))""",
    ),
    "two_system_report": (
        "queue sendable",
        """SELECT 'queued_observations' AS metric, count(*) AS n FROM queue
        UNION ALL SELECT 'log_rows', 2 * count(*) FROM sendable
        UNION ALL SELECT 'distinct_idempotency_keys', 2 * count(*) FROM sendable
        UNION ALL SELECT 'duplicate_idempotency_keys', 0
        UNION ALL SELECT 'dead_letter_rows', count(*) FROM (
          SELECT unnest([h, ('0x' || substr(sha256('cerner:' || patient_id || ':' || code || ':'
            || strftime(effective_datetime, '%Y-%m-%dT%H:%M:%S') || '+00:00'), 1, 4))::INTEGER]) AS h
          FROM sendable)
          WHERE NOT (h % 11 <> 0 AND ((h * 31) % 10 < 6 OR (h * 31 + 17) % 10 < 6
                                      OR (h * 31 + 34) % 10 < 6))""",
    ),
    "limited_batch": (
        "sent",
        """SELECT idempotency_key, 'generic_fhir' AS ehr_system, 'fhir' AS api, patient_id,
          code AS observation_code, CASE WHEN won THEN 'success' ELSE 'dead_lettered' END AS status,
          CASE WHEN NOT won OR (h * 31) % 10 >= 6 AND (h * 31 + 17) % 10 >= 6 THEN 2
               WHEN (h * 31) % 10 >= 6 THEN 1 ELSE 0 END::INTEGER AS retry_count
        FROM (SELECT * FROM sent ORDER BY effective_datetime, idempotency_key LIMIT 25)""",
    ),
    "quarantined_inputs": (
        "unsendable",
        """SELECT 'b1' AS batch_id, 'valid_value' AS failed_rules, count(*) AS n_rows
        FROM unsendable HAVING count(*) > 0""",
    ),
    "score_delivery_job": (
        "vitals score_keys registered",
        """SELECT succeeded, skipped, 0::BIGINT AS failed, dead_lettered,
          succeeded + skipped + dead_lettered AS total,
          succeeded::DOUBLE / (succeeded + skipped + dead_lettered) AS success_rate,
          (SELECT count(*) FROM vitals LEFT JOIN registered USING (patient_id)
           WHERE event_id % 53 = 0 OR event_id % 47 = 0 OR endpoint_patient_id IS NULL)
            AS quarantined
        FROM (SELECT count(*) FILTER (won) AS succeeded,
                sum(occurrences - 1)::BIGINT AS skipped,
                count(*) FILTER (NOT won) AS dead_lettered
              FROM (SELECT *, h % 11 <> 0 AND ((h * 31) % 10 < 6 OR (h * 31 + 17) % 10 < 6
                                               OR (h * 31 + 34) % 10 < 6) AS won FROM score_keys))""",
    ),
    "circuit_job": (
        "sendable",
        # Two tasks share a limit of 5: two failures each, then one each; two rows got requests.
        """SELECT t.* FROM (SELECT count(*) AS n FROM sendable), LATERAL (VALUES
          ('b1', n - 2, 0::BIGINT, n, 6::BIGINT), ('b2', n, 0, n, 0), ('b3', 0, n, 0, n))
          AS t(batch_id, n_gated, succeeded, dead_lettered, n_requests)""",
    ),
    "patient_create_job": (
        "people registered",
        """WITH asked AS (
          SELECT *, ('0x' || substr(sha256('identifier=urn:chartpost:patient|' || patient_id), 1, 4))::INTEGER AS h
          FROM people ANTI JOIN registered USING (patient_id)
        ), answered AS (
          SELECT *, h % 7 <> 0 AS won FROM asked
        )
        SELECT 'p1.patients' AS batch_id, patient_id,
          CASE WHEN NOT won THEN 'failed' WHEN h % 4 = 0 THEN 'known' ELSE 'created' END AS status,
          CASE WHEN won THEN 'fhir-' || patient_id END AS endpoint_patient_id,
          CASE WHEN NOT won THEN 'HTTP 503: busy ' || (h % 5) END AS error_message
        FROM answered
        UNION ALL
        SELECT 'p2.patients', patient_id, 'failed', NULL, 'HTTP 503: busy ' || (h % 5)
        FROM answered WHERE NOT won""",
    ),
    "delivery_rerun": (
        "sent unsendable",
        """SELECT batch_id, distinct_keys, succeeded, skipped, 0::BIGINT AS failed, dead_lettered,
          succeeded + skipped + dead_lettered AS total,
          succeeded::DOUBLE / (succeeded + skipped + dead_lettered) AS success_rate,
          CASE batch_id WHEN 'b1' THEN (SELECT count(*) FROM unsendable) ELSE 0 END AS quarantined
        FROM (
          SELECT 'b1' AS batch_id, count(*) AS distinct_keys, count(*) FILTER (won) AS succeeded,
            sum(occurrences - 1)::BIGINT AS skipped, count(*) FILTER (NOT won) AS dead_lettered
          FROM sent
          UNION ALL
          SELECT 'b2', count(*), 0,
            sum(CASE WHEN won THEN occurrences ELSE occurrences - 1 END)::BIGINT,
            count(*) FILTER (NOT won) FROM sent)""",
    ),
    "reprocess_job": (
        "sent",
        """SELECT idempotency_key, 'generic_fhir' AS ehr_system, 'fhir' AS api, patient_id,
          code AS observation_code, 'HTTP 503: busy ' || (h % 7) AS last_error,
          2 AS retry_count, won_later AS reprocessed FROM sent WHERE NOT won
        UNION ALL
        SELECT idempotency_key, 'generic_fhir', 'fhir', patient_id, code,
          'HTTP 503: busy ' || (h % 7), 1, false FROM sent WHERE NOT won AND NOT won_later""",
    ),
    "validation_job": (
        "queue sent",
        """SELECT 'queued_observations' AS metric, count(*) AS n FROM queue
        UNION ALL SELECT 'log_rows', count(*) FROM sent
        UNION ALL SELECT 'distinct_idempotency_keys', count(*) FROM sent
        UNION ALL SELECT 'duplicate_idempotency_keys', 0
        UNION ALL SELECT 'dead_letter_rows', count(*) FILTER (NOT won) FROM sent""",
    ),
}

ORACLE = {name: statement(views, body) for name, (views, body) in _STATEMENTS.items()}
