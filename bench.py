"""Headline queries at one scale; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_RUNS the timed
runs per query (the fastest counts; sessions warm up on an untimed first run).
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

from chartpost.plans.catalog import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = (
    "fhir_payloads",
    "flowsheet_payloads",
    "request_envelopes",
    "folded_batch",
    "duplicate_rows",
    "undelivered_observations",
    "batch_classes",
    "next_ready_batch",
    "retry_resolution",
    "circuit_now",
    "circuit_history",
    "ledger_current",
    "ledger_changes",
    "pending_dead_letters",
    "restored_letters",
    "readback_reconciliation",
    "cohort_scores",
    "score_observations",
    "validation_summary",
    "delivery_attempts",
    "ready_stream",
    "delivery_job",
    "score_delivery_job",
)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("chartpost-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # No call-site capture per expression; it only serves error messages.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="chartpost-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {}
    for name in HEADLINE:
        seconds(name)
        timings[name] = round(min(seconds(name) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
