"""Waves are read by many tasks, whatever the number that sends; an open circuit needs none."""

from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import functions as F

from chartpost.operators import delivery
from chartpost.operators.outcomes import CIRCUIT_OPEN
from chartpost.plans.jobs import Endpoint, run_delivery_batch
from chartpost.policies import Breaker, Retries
from chartpost.schemas import READY
from chartpost.session import prepare_session
from chartpost.sources.tables import append_rows, read_table

AT = datetime(2025, 6, 15, 10, 30, tzinfo=timezone.utc)


def ready(spark, workspace, n):
    rows = [
        (f"P{i}", None, "59408-5", None, "SpO2", 42.0, None, None, "%", AT, None, None, AT + timedelta(seconds=i), AT.date())
        for i in range(n)
    ]
    append_rows(spark.createDataFrame(rows, READY), workspace, "observations_ready")


def due(spark, n):
    at = F.timestamp_add("SECOND", F.col("id"), F.lit(AT))
    return spark.range(n).select(
        at.alias("queued_at"), at.alias("effective_datetime"), F.sha2(F.col("id").cast("string"), 256).alias("idempotency_key")
    )


def test_a_large_wave_is_several_ranges_in_order(spark, monkeypatch):
    monkeypatch.setattr(delivery, "ROWS_PER_FILE", 50)
    waves = delivery.split_waves(due(spark, 1_000), 1_000, 500).withColumn("part", F.spark_partition_id())
    seen = (
        waves.groupBy("wave")
        .agg(F.count_distinct("part").alias("parts"), F.count(F.lit(1)).alias("n"), F.min("queued_at").alias("low"), F.max("queued_at").alias("high"))
        .orderBy("wave")
        .collect()
    )
    assert [r.wave for r in seen] == [0, 1] and sum(r.n for r in seen) == 1_000
    assert all(r.parts >= 5 for r in seen)
    assert seen[0].high < seen[1].low


def test_small_waves_are_one_range(spark):
    waves = delivery.split_waves(due(spark, 10), 10, 500)
    assert [tuple(r) for r in waves.groupBy("wave").count().collect()] == [(0, 10)]


def test_a_wave_behind_an_open_circuit_opens_no_session(spark, workspace, tmp_path):
    ready(spark, workspace, 8)
    opened = str(tmp_path / "opened")

    def open_transport():
        with open(opened, "a") as log:
            log.write("x")
        return lambda url, headers, body: (503, "busy")

    target = Endpoint(
        "generic_fhir", "fhir", "https://fhir.example", open_transport,
        max_concurrency=1, max_rows_per_wave=2, retry=Retries(times=0), circuit=Breaker(limit=1),
        sleep=lambda seconds: None,
    )
    row = run_delivery_batch(spark, workspace, target, "b1").first()
    assert row.dead_lettered == 8
    assert open(opened).read() == "x"
    log = read_table(spark, workspace, "attempt_log")
    gated = log.where("gated").collect()
    assert len(gated) == 7 and log.count() == 8
    assert {(r.attempt, r.transport_error, r.ok, r.http_status, r.body) for r in gated} == {(0, CIRCUIT_OPEN, False, None, None)}
    assert all(r.seq > 0 and r.effective_date == AT.date() and r.endpoint == target.base_url for r in gated)


def test_attempts_take_their_columns_from_their_requests():
    batch = pa.RecordBatch.from_pydict(
        {
            "idempotency_key": ["a", "b"],
            "ehr_system": ["s", "s"],
            "api": ["fhir", None],
            "endpoint": ["e", "e"],
            "effective_date": pa.array([AT.date(), None], pa.date32()),
        }
    )
    rows = delivery.AttemptRows(10)
    rows.add(1, 0, 1.5, 503, "busy")
    rows.add(1, 1, 2.25, error="lost")
    rows.add(0, 0, 3.0, 201, "{}", ok=True)
    a, b, c = rows.flush(batch).to_pylist()
    assert [r["seq"] for r in (a, b, c)] == [11, 12, 13] and rows.rows == []
    assert (a["idempotency_key"], a["api"], a["effective_date"], a["http_status"], a["body"]) == ("b", None, None, 503, "busy")
    assert (b["attempt"], b["http_status"], b["transport_error"], b["ok"]) == (1, None, "lost", False)
    assert (c["idempotency_key"], c["effective_date"], c["ok"], c["gated"]) == ("a", AT.date(), True, False)
    assert a["attempted_at"] == datetime.fromtimestamp(1.5, timezone.utc)


def test_generated_methods_stay_small_enough_to_be_compiled(spark):
    assert int(prepare_session(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8_000
