from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


def make_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("cohort-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", "file:" + tempfile.mkdtemp(prefix="cohort-tests-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    return make_session()


@pytest.fixture(scope="session")
def folder() -> str:
    return "/root/testdata/sf0.001"
