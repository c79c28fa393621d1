from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from pedalstrata.sources import staging  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("pedalstrata-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True, scope="module")
def _released(spark):
    """Every module leaves no staged copy and no database of a query."""
    yield
    staging.release(spark)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture()
def db(spark, tmp_path):
    name = f"db_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    return name
