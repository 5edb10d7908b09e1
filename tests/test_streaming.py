"""The triggered stream against the batch form of the same step."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from chartpost.operators.normalize import ready_rows
from chartpost.plans import bindings
from chartpost.schemas import QUEUE
from chartpost.sources.tables import read_table, seed_queue
from chartpost.streaming.ready import refresh_ready

SF = "/root/testdata/sf0.001"
INSTANT = datetime(2025, 1, 1, tzinfo=timezone.utc)


def test_stream_equals_batch_and_sees_each_file_once(spark, workspace):
    at = F.lit(INSTANT)
    queue = bindings.obs_queue(spark, SF).select(*QUEUE.fieldNames())
    queue.write.mode("append").parquet(workspace.path("observations_queue"))
    query = refresh_ready(spark, workspace, at)
    got = read_table(spark, workspace, "observations_ready").drop("queued_date")
    want = ready_rows(queue, at)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()

    metrics = [p["observedMetrics"]["expectations"] for p in query.recentProgress if p["observedMetrics"]]
    assert sum(m["n_rows"] for m in metrics) == queue.count()
    assert (
        sum(m["valid_patient_failed"] for m in metrics)
        == queue.where("patient_id IS NULL").count()
    )

    refresh_ready(spark, workspace, at)
    assert read_table(spark, workspace, "observations_ready").count() == want.count()
    queue.limit(5).write.mode("append").parquet(workspace.path("observations_queue"))
    refresh_ready(spark, workspace, at)
    again = read_table(spark, workspace, "observations_ready").count()
    assert again == want.count() + ready_rows(queue.limit(5), at).count()


def test_seed(spark, workspace):
    seed_queue(spark, workspace, 70)
    rows = read_table(spark, workspace, "observations_queue").orderBy("patient_id").collect()
    assert len(rows) == 70
    assert (rows[3].patient_id, rows[3].value) == ("DEMO-003", 63.0)
    assert rows[65].effective_datetime == datetime(2026, 3, 21, 13, 5)
