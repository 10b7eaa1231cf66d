from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    """One small session with ANSI on, as Spark has it by default."""
    folder = tempfile.mkdtemp(prefix="tallygate-test-")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tallygate-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
