"""Session settings and lineage cuts shared by every job."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings a delivery session relies on.  Only runtime settings: master,
# memory and executor counts belong to whoever submits the job.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # JVMs do not compile methods of more bytes; rows as wide as these are better split up.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings (UTC instants, adaptive execution)."""
    for name, value in RUNTIME_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, as the cluster names it.

    Only a local session without the setting gets a temporary folder; on a
    cluster a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="chartpost-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once, in reliable storage."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on the executors, once per application.

    Only the sending step runs Python there.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="chartpost-")) / "chartpost.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(package.rglob("*.py")):
            bundle.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
