"""Session settings the engine relies on."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


# How the contract reads times.  All are UTC, dates are taken in UTC, and a
# text either fits the timestamp format or is no timestamp.
_TIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
}


# Bytes on storage for each shuffle partition.
_TASK_BYTES = 64 << 20


def use_contract_time(spark: SparkSession) -> None:
    """Set the session to the contract's reading of times."""
    for name, value in _TIME.items():
        if spark.conf.get(name) != value:
            spark.conf.set(name, value)


def shuffles_for(spark: SparkSession, size: int) -> dict[str, str]:
    """Settings for shuffling so many bytes: at least one partition for each 64 MiB.

    The session's own number stands if it is larger.  Adaptive execution merges partitions
    that turn out small, but it never makes more of them than it was given.  Rows take several
    times the bytes in a task that they take on storage; with these, sorting them doesn't spill.
    """
    name = "spark.sql.shuffle.partitions"
    return {name: str(max(int(spark.conf.get(name)), math.ceil(size / _TASK_BYTES)))}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Apply settings for the length of a block, then put the earlier ones back."""
    earlier = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in earlier.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
