import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).parent.parent
for folder in (ROOT, Path(__file__).parent):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("chartpost-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from chartpost.session import prepare_session

    yield prepare_session(session)
    session.stop()


@pytest.fixture
def workspace(spark, tmp_path):
    from chartpost.sources.tables import Workspace, ensure_tables

    place = Workspace(str(tmp_path / "workspace"))
    ensure_tables(spark, place)
    return place
