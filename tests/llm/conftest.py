from __future__ import annotations

import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(autouse=True, scope="session")
def importable(spark):
    """Python workers import this repository's modules."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
