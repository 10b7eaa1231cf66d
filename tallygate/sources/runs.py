"""Published runs: where each dataset of a run lives, and how to read it back.

Every run owns one directory per dataset, named by its id, and never shares or overwrites
it.  The directories are Hive-style partitions, so the datasets of all runs also form
tables, and a filter on ``run_id`` prunes down to one directory.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from tallygate.contract import DAILY_SALES, ORDER_LINES, QUARANTINE, RUN_METRICS, SUPERSEDED
from tallygate.operators.quality import checked_run_id
from tallygate.session import settings
from tallygate.sources import files

_RUN = StructField("run_id", StringType())

SUCCESS_MARKER = StructType(
    [
        *RUN_METRICS.fields,
        StructField("batch_date", StringType()),
        StructField("completed_at", StringType()),
    ]
)


class MarkerError(ValueError):
    """The success marker is missing or belongs to another snapshot."""


class ManifestError(ValueError):
    """There are no data files to list."""


@dataclass(frozen=True)
class RunLayout:
    """Paths of one run below the output root."""

    root: str
    run_id: str

    def __post_init__(self) -> None:
        checked_run_id(self.run_id)
        object.__setattr__(self, "root", self.root.rstrip("/"))

    def _of_run(self, dataset: str) -> str:
        return f"{self.root}/{dataset}/run_id={self.run_id}"

    @property
    def quarantine(self) -> str:
        return self._of_run("quarantine")

    @property
    def superseded(self) -> str:
        return self._of_run("audit/duplicates")

    @property
    def order_lines(self) -> str:
        return self._of_run("silver/order_lines")

    @property
    def daily_sales(self) -> str:
        return self._of_run("gold/daily_sales")

    @property
    def staging(self) -> str:
        return self._of_run("staging")

    @property
    def manifests(self) -> str:
        return f"{self.root}/manifests/{self.run_id}"

    @property
    def load_manifest(self) -> str:
        return f"{self.manifests}/load_manifest"

    def marker(self, name: str) -> str:
        return f"{self.manifests}/{name}.json"

    def outputs(self) -> list[str]:
        return [
            self.manifests,
            self.order_lines,
            self.daily_sales,
            self.quarantine,
            self.superseded,
        ]


def _read_run(spark: SparkSession, base: str, path: str, schema: StructType) -> DataFrame:
    """One run's dataset, found by its path alone; other runs are not even listed.

    The directories of a run are listed by as many tasks as there are cores, where Spark
    would start a task for each directory.
    """
    known = StructType([*schema.fields, _RUN])
    cores = spark.sparkContext.defaultParallelism
    with settings(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(cores)}):
        return spark.read.schema(known).option("basePath", base).parquet(path)


def read_order_lines(
    spark: SparkSession, root: str, run_id: str, published: bool = True
) -> DataFrame:
    """Current lines of a published run; a filter on ``order_date`` prunes directories.

    ``published=False`` also reads what an unfinished or failed run has left.
    """
    layout = RunLayout(root, run_id)
    if published:
        success_marker(spark, root, run_id)
    lines = _read_run(
        spark, f"{layout.root}/silver/order_lines", layout.order_lines, ORDER_LINES
    )
    return lines.select(*ORDER_LINES.fieldNames(), "run_id")


def read_daily_sales(
    spark: SparkSession, root: str, run_id: str, published: bool = True
) -> DataFrame:
    layout = RunLayout(root, run_id)
    if published:
        success_marker(spark, root, run_id)
    return _read_run(spark, f"{layout.root}/gold/daily_sales", layout.daily_sales, DAILY_SALES)


def read_quarantine(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    layout = RunLayout(root, run_id)
    return _read_run(spark, f"{layout.root}/quarantine", layout.quarantine, QUARANTINE)


def read_superseded(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    layout = RunLayout(root, run_id)
    return _read_run(spark, f"{layout.root}/audit/duplicates", layout.superseded, SUPERSEDED)


def of_published_runs(frame: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows that belong to a published run, from a table over the runs of a root."""
    return frame.join(runs.select("run_id").distinct(), "run_id", "left_semi")


def success_marker(
    spark: SparkSession, root: str, run_id: str, batch_date: str | None = None
) -> dict[str, Any]:
    """The metrics of one published run, after checking whose they are."""
    path = RunLayout(root, run_id).marker("success")
    if not files.exists(spark, path):
        raise MarkerError(f"Run {run_id} has no success marker, so it is not published")
    found = spark.read.schema(SUCCESS_MARKER).option("multiLine", True).json(path).first()
    marker = found.asDict() if found else {}
    wanted = {"run_id": run_id} | ({"batch_date": batch_date} if batch_date else {})
    if {name: marker.get(name) for name in wanted} != wanted:
        raise MarkerError(f"Success marker of {run_id} does not match the requested snapshot")
    return marker


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """Path and length of the non-empty Parquet files of a dataset; no file is opened."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return found.select(F.col("_metadata.file_path").alias("path"), "length")


MANIFEST = StructType(
    [
        StructField("url", StringType()),
        StructField("mandatory", BooleanType()),
        StructField("meta", StructType([StructField("content_length", LongType())])),
        StructField("row_count", LongType()),
        StructField("digest", StringType()),
    ]
)
# Entries of one part of a manifest.
_ENTRIES_PER_PART = 100_000


def row_digest(schema: StructType) -> Column:
    """The sum of a hash of each row: the same for the same rows in any order."""
    hashed = F.xxhash64(*schema.fieldNames()).cast("decimal(38,0)")
    return F.coalesce(F.sum(hashed), F.lit(0)).cast("decimal(38,0)")


def write_manifest(spark: SparkSession, path: str, schema: StructType, target: str) -> None:
    """List the files a mart load has to read, all of them mandatory, as a dataset sorted by path.

    Each entry has the file's length, its rows and a digest of them; that takes one scan of the
    dataset. A dataset without data files is no snapshot.
    """
    listed = data_files(spark, path)
    number = listed.count()
    if not number:
        raise ManifestError(f"No Parquet files below {path}; an empty manifest is no snapshot")
    held = (
        spark.read.schema(schema)
        .parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.count(F.lit(1)).alias("row_count"), row_digest(schema).alias("digest"))
    )
    entries = listed.join(held, "path", "left").select(
        F.col("path").alias("url"),
        F.lit(True).alias("mandatory"),
        F.struct(F.col("length").alias("content_length")).alias("meta"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.coalesce("digest", F.lit(0).cast("decimal(38,0)")).cast("string").alias("digest"),
    )
    parts = 1 + number // _ENTRIES_PER_PART
    entries.repartitionByRange(parts, "url").sortWithinPartitions("url").write.json(target)


def write_empty_manifest(spark: SparkSession, target: str) -> None:
    """The manifest of a snapshot without rows."""
    spark.createDataFrame([], MANIFEST).write.json(target)


def read_manifest(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """A run's manifest, after checking that its files are there and have their lengths."""
    layout = RunLayout(root, run_id)
    entries = spark.read.schema(MANIFEST).json(layout.load_manifest)
    there = data_files(spark, layout.daily_sales).withColumnRenamed("path", "url")
    changed = entries.join(there, "url", "left").filter(
        ~F.col("meta.content_length").eqNullSafe(F.col("length"))
    )
    if not changed.isEmpty():
        raise ManifestError(f"Files of {run_id} are not as its manifest lists them")
    return entries


def read_listed_daily_sales(
    spark: SparkSession, root: str, run_id: str, entries: DataFrame
) -> DataFrame:
    """Daily sales of a run from exactly the listed files; no entry means an empty snapshot."""
    rows = spark.read.schema(DAILY_SALES).parquet(RunLayout(root, run_id).daily_sales)
    named = rows.withColumn("url", F.col("_metadata.file_path"))
    return named.join(entries.select("url"), "url", "left_semi").select(*DAILY_SALES.fieldNames())
