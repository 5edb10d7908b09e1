"""Parquet tables of a workspace: creation, reads, appends and the demo seed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartpost.schemas import LOINC, TABLES


@dataclass(frozen=True)
class Workspace:
    """A folder holding the state tables, on storage every executor can reach."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"


def _folder(spark: SparkSession, path: str):
    """Hadoop path and the file system it is on, as the session configures it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether an earlier run finished writing ``path``."""
    marker, files = _folder(spark, f"{path}/_SUCCESS")
    return files.exists(marker)


def drop_finished_plans(spark: SparkSession, workspace: Workspace) -> int:
    """Delete the plans of batches whose summary is complete; returns how many.

    A finished batch is answered from its summary, so only running ones need their plan.
    """
    plans, files = _folder(spark, workspace.path("plans"))
    if not files.exists(plans):
        return 0
    done = [
        entry.getPath()
        for entry in files.listStatus(plans)
        if any(
            is_complete(spark, batch_path(workspace, table, batch_id=entry.getPath().getName()))
            for table in ("delivery_batches", "patient_links")
        )
    ]
    for folder in done:
        files.delete(folder, True)
    return len(done)


def ensure_tables(spark: SparkSession, workspace: Workspace, database: str | None = None) -> None:
    """Create missing tables; with ``database``, also register them in the catalog.

    A table is a folder read with its declared schema, so an empty one needs no file.
    """
    for table in TABLES:
        folder, files = _folder(spark, workspace.path(table))
        files.mkdirs(folder)
    if database is None:
        return
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table, (schema, partitions) in TABLES.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        spread = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING parquet {spread} "
            f"LOCATION '{workspace.path(table)}'"
        )


def read_table(spark: SparkSession, workspace: Workspace, table: str) -> DataFrame:
    """Read with the declared schema: no inference, no footer merge."""
    return spark.read.schema(TABLES[table][0]).parquet(workspace.path(table))


def append_rows(df: DataFrame, workspace: Workspace, table: str) -> None:
    """Append in table column order; adaptive execution sizes the files per partition value."""
    schema, partitions = TABLES[table]
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    if partitions:
        rows = rows.hint("rebalance", *partitions)
    rows.write.mode("append").partitionBy(*partitions).parquet(workspace.path(table))


def batch_path(workspace: Workspace, table: str, **partition: object) -> str:
    """Folder of one partition, e.g. ``attempt_log/batch_id=b1/wave=0``."""
    return "/".join([workspace.path(table), *(f"{k}={v}" for k, v in partition.items())])


def replace_batch(df: DataFrame, workspace: Workspace, table: str, **partition: object) -> None:
    """Write one partition as a whole, with a completion marker in its folder.

    A run that stopped halfway leaves no marker, so the next one writes the whole
    partition again and it is there once.
    """
    schema, partitions = TABLES[table]
    names = [f for f in schema.fields if f.name not in partition]
    inner = [name for name in partitions if name not in partition]
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in names])
    if inner:
        rows = rows.hint("rebalance", *inner)
    rows.write.mode("overwrite").partitionBy(*inner).parquet(batch_path(workspace, table, **partition))


def write_once(
    spark: SparkSession, df: DataFrame, workspace: Workspace, table: str, **partition: object
) -> None:
    """``replace_batch``, unless an earlier run has finished the partition."""
    if not is_complete(spark, batch_path(workspace, table, **partition)):
        replace_batch(df, workspace, table, **partition)


def drop_batch(spark: SparkSession, workspace: Workspace, table: str, **partition: object) -> None:
    """Delete one partition of a state table that a later one has replaced."""
    folder, files = _folder(spark, batch_path(workspace, table, **partition))
    files.delete(folder, True)


def demo_rows(index: DataFrame, column: str = "index") -> DataFrame:
    """Deterministic queue rows, one per index value.

    Minutes are added to the base instant, so indexes beyond 59 stay valid.
    """
    i: Column = F.col(column)
    padded = F.format_string("%03d", i)
    return index.select(
        F.concat(F.lit("DEMO-"), padded).alias("patient_id"),
        F.concat(F.lit("ENC-"), padded).alias("encounter_id"),
        F.lit("8867-4").alias("observation_code"),
        F.lit(LOINC).alias("code_system"),
        F.lit("Heart rate").alias("display_name"),
        (i + 60).cast("double").alias("value"),
        F.lit("beats/minute").alias("unit"),
        F.timestamp_add("MINUTE", i, F.lit("2026-03-21 12:00:00").cast("timestamp")).alias(
            "effective_datetime"
        ),
        F.lit("demo").alias("source_system"),
    )


def seed_queue(spark: SparkSession, workspace: Workspace, count: int = 10) -> None:
    """Replace the queue with ``count`` demo rows."""
    demo_rows(spark.range(count).withColumnRenamed("id", "index")).write.mode("overwrite").parquet(
        workspace.path("observations_queue")
    )
