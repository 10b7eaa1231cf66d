"""Write the bridged snapshot as CSV files, and publish and promote it."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harness.bridge import order_line_versions, roomy_joins
from tallygate.contract import SOURCE_COLUMNS
from tallygate.functions.rules import computed_once
from tallygate.plans.lake import add_run, create_lake_tables
from tallygate.plans.promote import promote_run
from tallygate.plans.publish import publish_snapshot
from tallygate.sources import files

# The bridge plants defects in about a tenth of all lines.
MOST_REJECTED = 0.25
BATCH_DATE = "2026-01-15"
RUN_ID = "snapshot-1"


_OWN: list[str] = []


def shared_folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A folder of one query where the whole cluster can write; what an earlier call left goes.

    It stands below ``spark.checkpoint.dir``. Only a session on one machine may do without.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.sparkContext.master
        if not master.startswith("local[") and master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="tallygate-"))
        base = _OWN[0]
    tables = uuid.uuid5(uuid.NAMESPACE_URL, sf_dir).hex
    path = f"{base.rstrip('/')}/tallygate-{spark.sparkContext.applicationId}/{tables}/{name}"
    files.remove(spark, path)
    return path


def _field(name: str) -> Column:
    """CSV form of a value: quoted where it holds a comma or a quote."""
    value = F.col(name)
    quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(F.contains(value, F.lit(",")) | F.contains(value, F.lit('"')), quoted).otherwise(value)


def damaged_line() -> Column:
    """A version's CSV line, with the damage planted for it.

    It is compiled apart from whole-stage code, where the method for a line with twelve quoted columns takes
    over 8,000 bytes, and the JVM leaves such a method uncompiled.
    """
    line = F.concat_ws(",", *map(_field, SOURCE_COLUMNS))
    damaged = (
        F.when(F.col("damage") == "extra", F.concat(line, F.lit(",surplus")))
        .when(F.col("damage") == "quote", F.concat(F.lit('"'), line))
        .otherwise(line)
    )
    return computed_once(damaged)


# How the files of ``write_headed_files`` begin, by number; the first lines of 1 and 3 are no header.
_HEADER = ",".join(SOURCE_COLUMNS)
OPENINGS = [
    [_HEADER],
    ["", _HEADER],
    ["\ufeff" + _HEADER, "", "   "],
    [",".join(reversed(SOURCE_COLUMNS)), _HEADER],
    [",".join(f'"{name}"' for name in SOURCE_COLUMNS), _HEADER],
]


#: Line numbers that an order commonly has; only the number of tasks goes by it.
_NUMBERS = 8

#: The number of the file that has no line at all.
EMPTY_FILE = 1000


#: Lines of the snapshot for each share of a line number.
LINES_A_SHARE = 1_000_000


def write_headed_files(versions: DataFrame, path: str, shares: int = 1) -> str:
    """The snapshot's lines in ``shares`` files for each line number, each opened in one of five ways,
    and an empty file. With one share, all lines of a number go through one task."""
    number = F.coalesce(F.col("line_id").try_cast("int"), F.lit(0))
    share = F.pmod(F.xxhash64("order_id", "product_id", "updated_at"), F.lit(shares))
    data = versions.select(
        number.alias("file"), share.alias("share"), F.lit(len(SOURCE_COLUMNS)).alias("at"), damaged_line().alias("value")
    )
    files_there = data.select("file", "share").distinct()
    openings = F.array(*[F.array(*map(F.lit, lines)) for lines in OPENINGS])
    opening = F.posexplode(F.get(openings, F.col("file") % len(OPENINGS))).alias("at", "value")
    lines = files_there.select("file", "share", opening).unionByName(data)
    if shares == 1:
        dealt, folders, empty = lines.repartition("file"), ["file"], f"file={EMPTY_FILE}"
    else:  # a folder for each share, so that a task writes a file of its own for each
        dealt, folders = lines.repartition(shares * _NUMBERS, "file", "share"), ["file", "share"]
        empty = f"file={EMPTY_FILE}/share=0"
    ordered = dealt.sortWithinPartitions(*folders, "at").select("value", *folders)
    ordered.write.partitionBy(*folders).text(path)
    files.touch(versions.sparkSession, f"{path}/{empty}/part-0.txt")
    return path


def write_snapshot_csv(versions: DataFrame, path: str) -> str:
    """Compressed CSV files led by the header, with the planted damage, one file per task.

    The lines are made here, because no CSV writer writes broken ones.  Spark's writer gets
    them as a single column that is named like the header line, with quoting off.
    """
    return write_csv_lines(versions.select(damaged_line()), path)


def write_csv_lines(lines: DataFrame, path: str) -> str:
    """Data lines of a single text column as compressed CSV files led by the header, one for each task."""
    as_is = {
        "header": True,
        "sep": "\u0001",
        "quote": "\u0000",
        "escape": "\u0000",
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        "emptyValue": "",
        "compression": "gzip",
    }
    lines.toDF(_HEADER).write.options(**as_is).csv(path)
    return path


def landed_lines(spark: SparkSession, raw: str) -> DataFrame:
    """The data lines of files that ``write_csv_lines`` wrote, as they are; column ``value``."""
    return spark.read.text(raw).filter(F.col("value") != _HEADER)


def cancelled_line() -> Column:
    """A landed line with its status cancelled if it is completed; a surplus field may follow it."""
    return F.regexp_replace("value", r"(?i),[ ]*completed[ ]*(,surplus)?$", ",cancelled$1")


@dataclass(frozen=True)
class Landed:
    root: str
    raw: str
    mart: str
    run_id: str = RUN_ID


_LANDED: dict[tuple[str, str, str], Landed] = {}


def _once(spark: SparkSession, sf_dir: str, step: str) -> Landed | None:
    return _LANDED.get((spark.sparkContext.applicationId, sf_dir, step))


def _note(spark: SparkSession, sf_dir: str, step: str, landed: Landed) -> Landed:
    return _LANDED.setdefault((spark.sparkContext.applicationId, sf_dir, step), landed)


def landed(spark: SparkSession, sf_dir: str) -> Landed:
    """The snapshot of a scale factor as CSV files; written once per application."""
    known = _once(spark, sf_dir, "raw")
    if known:
        return known
    root = shared_folder(spark, sf_dir, "landed")
    raw = f"{root}/raw/batch_date={BATCH_DATE}"
    with roomy_joins(spark, sf_dir):
        write_snapshot_csv(order_line_versions(spark, sf_dir), raw)
    return _note(spark, sf_dir, "raw", Landed(root, raw, f"{root}/mart"))


def published(spark: SparkSession, sf_dir: str) -> Landed:
    known = _once(spark, sf_dir, "run")
    if known:
        return known
    place = landed(spark, sf_dir)
    publish_snapshot(spark, place.raw, place.root, place.run_id, BATCH_DATE, MOST_REJECTED)
    return _note(spark, sf_dir, "run", place)


def in_lake(spark: SparkSession, sf_dir: str) -> str:
    """Name of the database whose tables show the published run."""
    place = published(spark, sf_dir)
    database = f"lake_{uuid.uuid5(uuid.NAMESPACE_URL, place.root).hex}"
    if not _once(spark, sf_dir, "lake"):
        create_lake_tables(spark, database, place.root)
        add_run(spark, database, place.root, place.run_id)
        _note(spark, sf_dir, "lake", place)
    return database


def promoted(spark: SparkSession, sf_dir: str) -> Landed:
    known = _once(spark, sf_dir, "mart")
    if known:
        return known
    place = published(spark, sf_dir)
    promote_run(spark, place.root, place.mart, place.run_id)
    return _note(spark, sf_dir, "mart", place)
