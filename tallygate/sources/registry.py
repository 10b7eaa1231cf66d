"""The registry of published runs: a compacted table and a short tail of names.

A run is published by its success marker. So that nobody has to list the folders of all runs, a run
also leaves its name in ``registry/log`` before that marker is written; a name without a marker
is a run under way or a failed one. Now and then the metrics of all named runs go into a
new table, ``registry/snapshot=<number>``, and their names go. Readers take the names first, then the
newest whole table by its number, so they see every run at any moment of a compaction, and read
one marker for each name of the tail, however many runs there are.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tallygate.sources import files
from tallygate.sources.runs import SUCCESS_MARKER, RunLayout

#: Names in the tail that a compaction waits for.
TAIL = 64
# Tables that stay for readers who have found them already.
_TABLES_KEPT = 2


def _place(root: str) -> str:
    return f"{root.rstrip('/')}/registry"


def announce_run(spark: SparkSession, layout: RunLayout) -> None:
    """Leave a run's name; do so before its success marker is written."""
    files.touch(spark, f"{_place(layout.root)}/log/{layout.run_id}")


def _tail(spark: SparkSession, root: str) -> list[str]:
    return sorted(n for n in files.modified(spark, f"{_place(root)}/log") if not n.startswith("."))


def _tables(spark: SparkSession, root: str) -> list[str]:
    """Whole tables, oldest first."""
    found = sorted(n for n in files.modified(spark, _place(root)) if n.startswith("snapshot="))
    return [n for n in found if files.exists(spark, f"{_place(root)}/{n}/_SUCCESS")]


def _markers(spark: SparkSession, root: str, names: list[str]) -> DataFrame | None:
    paths = [RunLayout(root, name).marker("success") for name in names]
    there = [path for path in paths if files.exists(spark, path)]
    return spark.read.schema(SUCCESS_MARKER).json(there) if there else None


def published_runs(spark: SparkSession, root: str) -> DataFrame:
    """Metrics of every run that has a success marker; only these may be read."""
    tail = _markers(spark, root, _tail(spark, root))
    tables = _tables(spark, root)
    if not tables:
        return spark.createDataFrame([], SUCCESS_MARKER) if tail is None else tail
    compacted = spark.read.schema(SUCCESS_MARKER).parquet(f"{_place(root)}/{tables[-1]}")
    if tail is None:
        return compacted
    return compacted.unionByName(tail.join(compacted.select("run_id"), "run_id", "left_anti"))


def compact_registry(spark: SparkSession, root: str, least: int = TAIL) -> bool:
    """Write a new table once the tail has ``least`` names; names of runs under way stay.

    Two compactions at once write the same runs; the later number wins and holds all of them.
    """
    names = _tail(spark, root)
    if len(names) < max(1, least):
        return False
    done = [n for n in names if files.exists(spark, RunLayout(root, n).marker("success"))]
    failed = [n for n in names if files.exists(spark, RunLayout(root, n).marker("failure"))]
    tables = sorted(n for n in files.modified(spark, _place(root)) if n.startswith("snapshot="))
    number = int(tables[-1].split("=")[1]) + 1 if tables else 1
    try:
        published_runs(spark, root).write.parquet(f"{_place(root)}/snapshot={number:010d}")
    except AnalysisException as taken:
        if "PATH_ALREADY_EXISTS" not in str(taken.getCondition()):
            raise
        return False  # by another compaction, which has these runs as well
    for name in {*done, *failed}:
        files.remove(spark, f"{_place(root)}/log/{name}")
    for old in tables[:-_TABLES_KEPT]:
        files.remove(spark, f"{_place(root)}/{old}")
    return True


def scan_markers(spark: SparkSession, root: str) -> DataFrame:
    """The same by listing the folders of all runs, to check a registry or to begin one."""
    return (
        spark.read.schema(SUCCESS_MARKER)
        .options(recursiveFileLookup=True, pathGlobFilter="success.json")
        .json(f"{root.rstrip('/')}/manifests")
    )
