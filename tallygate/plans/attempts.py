"""The journal of build attempts, and what becomes of their staged data.

An attempt writes a record before it stages anything and another one when it ends. One without an
end is under way, or its driver is dead; its record says where its staged data is, so that it can be
found and removed. An attempt that a gate has turned down may leave its staged lines for another
one with a higher limit, which then need not read and parse the raw files again.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tallygate.sources import files
from tallygate.sources.runs import RunLayout

ATTEMPTS = StructType(
    [
        *(StructField(name, StringType()) for name in ("attempt", "run_id", "staging", "source", "rules")),
        StructField("began", DoubleType()),
    ]
)
_ENDS = StructType([StructField("attempt", StringType()), StructField("outcome", StringType())])
PUBLISHED, FAILED, KEPT, LOST = "published", "failed", "kept", "lost"


class StagingError(ValueError):
    """Staged data cannot be used again."""


@dataclass(frozen=True)
class Attempt:
    layout: RunLayout
    attempt: str
    staging: str

    @property
    def _journal(self) -> str:
        return f"{_place(self.layout.root)}/{self.attempt}"

    def end(self, spark: SparkSession, outcome: str) -> None:
        """Note how the attempt ended; its staged data goes, unless it is kept for another one."""
        if outcome != KEPT:
            files.remove(spark, self.staging)
        record = {"attempt": self.attempt, "outcome": outcome}
        files.write_once(spark, f"{self._journal}.{outcome}.ended.json", record)


def _place(root: str) -> str:
    return f"{root.rstrip('/')}/attempts"


def source_digest(spark: SparkSession, source: str | Sequence[str]) -> str:
    """The same for the same files: how many have lines, and a sum over names, lengths and times."""
    listed = spark.read.format("binaryFile").load(source)
    hashed = F.xxhash64("path", "length", "modificationTime")
    row = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum(hashed.cast("decimal(38,0)")), F.lit(0))).first()
    return f"{row[0]}:{row[1]}"


def begin_attempt(spark: SparkSession, layout: RunLayout, source: str, rules: str) -> Attempt:
    name = uuid.uuid4().hex
    attempt = Attempt(layout, name, f"{layout.staging}-{name}")
    record = {
        "attempt": name, "run_id": layout.run_id, "staging": attempt.staging, "source": source,
        "rules": rules, "began": time.time(),
    }
    files.write_once(spark, f"{_place(layout.root)}/{name}.begun.json", record)
    return attempt


def _journal(spark: SparkSession, root: str, kind: str, schema: StructType) -> DataFrame:
    if not files.exists(spark, _place(root)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("pathGlobFilter", f"*.{kind}.json").json(_place(root))


def attempts(spark: SparkSession, root: str) -> DataFrame:
    """Every attempt with its outcome; null while it is under way or where its driver died."""
    begun = _journal(spark, root, "begun", ATTEMPTS)
    ended = _journal(spark, root, "ended", _ENDS).groupBy("attempt").agg(
        # staged data that was kept and then used or lost has two ends
        F.min_by("outcome", F.col("outcome") == KEPT).alias("outcome")
    )
    return begun.join(ended, "attempt", "left")


def live_staging(spark: SparkSession, root: str) -> DataFrame:
    """Attempts whose staged data still stands: those without an end, and those kept for reuse."""
    return attempts(spark, root).filter(F.col("outcome").isNull() | (F.col("outcome") == KEPT))


def staged_for_reuse(
    spark: SparkSession, root: str, attempt: str, source: str, rules: str
) -> str:
    """Where an attempt has kept its lines, if they are those of the same files and rules."""
    found = live_staging(spark, root).filter(F.col("attempt") == attempt).first()
    if found is None or found.outcome != KEPT:
        raise StagingError(f"Attempt {attempt} has kept no staged lines")
    if (found.source, found.rules) != (source, rules):
        raise StagingError(f"Attempt {attempt} staged other files or went by other rules")
    return found.staging


def recover_attempts(spark: SparkSession, root: str, older_than: float) -> list[str]:
    """Remove what attempts that began over ``older_than`` seconds ago have left, kept lines included,
    and mark their runs as failed where nothing is marked. Returns the attempts; choose a time that no
    run takes."""
    old = live_staging(spark, root).filter(F.col("began") < time.time() - older_than)
    gone = []
    for row in old.select("attempt", "run_id", "staging").collect():  # of dead drivers: a few
        layout = RunLayout(root, row.run_id)
        Attempt(layout, row.attempt, row.staging).end(spark, LOST)
        if not any(files.exists(spark, layout.marker(name)) for name in ("success", "failure")):
            files.write_once(spark, layout.marker("failure"), {"run_id": row.run_id, "lost": row.attempt})
        gone.append(row.attempt)
    return gone
