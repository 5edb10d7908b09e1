"""Intermediate tables in the shared folder, and checks before a broadcast."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartpost.session import prepare_session, shared_dir, ship_package

CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Rows of one key and a few numbers each; about 10 MB.
BROADCAST_ROWS = 100_000


# Rows and bytes handed to Python at a time.  Whole texts are long; a batch and its copies
# count against the memory of every task.
ARROW_LIMITS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def session(spark: SparkSession) -> SparkSession:
    """Runtime settings, and this package on the executors."""
    ship_package(spark)
    for name, limit in ARROW_LIMITS.items():
        if spark.conf.get(name, None) != limit:
            spark.conf.set(name, limit)
    return prepare_session(spark)


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Shuffle files of the queries run inside go when each query ends.

    For writes of whole texts or ids: the table written replaces the shuffle.
    """
    before = spark.conf.get(CLEANUP_CONF, "false")
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_CONF, before)


def store(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once to the shared folder and read it from there.

    Later steps start from the files, so a lost executor costs one task, not the
    steps before.
    """
    folder = new_folder(df.sparkSession, label)
    df.write.option("compression", codec).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def broadcast_if_bounded(stored: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a stored narrow table for broadcast when its row count is within the bound.

    Beyond it the join shuffles, and adaptive execution splits its hot keys.
    """
    return F.broadcast(stored) if stored.count() <= max_rows else stored
