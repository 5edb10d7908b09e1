"""Queue stream -> validated, stamped ready table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chartpost.operators.expectations import count_failures, queue_rules
from chartpost.operators.normalize import ready_rows
from chartpost.schemas import QUEUE
from chartpost.sources.tables import Workspace


def queue_stream(
    spark: SparkSession, workspace: Workspace, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Every newly queued file, once."""
    reader = spark.readStream.schema(QUEUE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(workspace.path("observations_queue"))


def start_ready_stream(
    queue: DataFrame, workspace: Workspace, queued_at: Column | None = None
) -> StreamingQuery:
    """Process what is there, then stop (triggered, not continuous).

    Failing rows per rule are in the query progress under ``expectations``.  The
    stream keeps no state: duplicates are folded in the delivery batch.
    """
    observed = queue.observe(
        "expectations", F.count(F.lit(1)).alias("n_rows"), *count_failures(queue_rules())
    )
    rows = ready_rows(observed, queued_at).withColumn("queued_date", F.to_date("queued_at"))
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("queued_date")
        .option("path", workspace.path("observations_ready"))
        .option("checkpointLocation", workspace.path("_checkpoints/observations_ready"))
        .trigger(availableNow=True)
        .start()
    )


def refresh_ready(
    spark: SparkSession, workspace: Workspace, queued_at: Column | None = None
) -> StreamingQuery:
    """Run the triggered stream to its end."""
    query = start_ready_stream(queue_stream(spark, workspace), workspace, queued_at)
    query.awaitTermination()
    return query
