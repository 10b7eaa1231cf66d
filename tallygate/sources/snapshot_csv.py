"""Read a complete order-line snapshot from CSV files as untyped rows.

The text source hands out physical lines; telling headers and blank lines apart, splitting
and width checks are column expressions, so the read is one narrow stage on the JVM.

Header contract: the first line of every file must be the header.  Which line comes first
is only known by comparing lines of the same file, so each line from the opening split of
a file keeps its *place* in scan order, and one small aggregation per file finds the
earliest.  The check can therefore run over lines that were already written somewhere,
without a second read of the raw files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygate.contract import CORRUPT, SOURCE_COLUMNS, SOURCE_FILE
from tallygate.functions.fields import (
    is_blank,
    is_header,
    split_fields,
    without_byte_order_mark,
)

KIND = "line_kind"
PLACE = "line_place"
DATA, HEADER, BLANK = "data", "header", "blank"

#: Files that an error message names; the error holds all of them as a DataFrame.
_FILES_NAMED = 5


class HeaderError(ValueError):
    """A file of the snapshot does not begin with the header of the contract.

    ``unsound`` has the names of all such files, or None where only a text is known.
    """

    def __init__(self, message: str, unsound: DataFrame | None = None):
        super().__init__(message)
        self.unsound = unsound


def files_with_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Name and length of the files that are not empty: a scan that opens none of them."""
    listed = spark.read.format("binaryFile").load(path)
    return listed.select(F.input_file_name().alias(SOURCE_FILE), "length")


class SnapshotFiles:
    """The files of a snapshot, empty ones included.

    How many there are is known from the listing that Spark plans its scans by. Names come from
    scans; no scan ever emits an empty file, so where one is missing that listing is handed back to
    Spark as a literal. Python sees no list of names either way.
    """

    def __init__(self, spark: SparkSession, path: str | Sequence[str]):
        self._spark, self._path = spark, path
        self._listing = spark.read.text(path)._jdf.inputFiles()  # stays in the JVM

    def __len__(self) -> int:
        return len(self._listing)

    def frame(self) -> DataFrame:
        """Name and length of every file."""
        filled = files_with_lines(self._spark, self._path)
        if filled.count() == len(self):
            return filled
        every = self._spark.range(1).select(F.explode(F.lit(self._listing)).alias(SOURCE_FILE))
        empty = every.join(filled, SOURCE_FILE, "left_anti").withColumn("length", F.lit(0).cast("long"))
        return filled.unionByName(empty)


def snapshot_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Every physical line with its file, its kind, and its place in the opening split."""
    line = F.col("value")
    kind = (
        F.when(is_blank(line), BLANK)
        .when(is_header(line, SOURCE_COLUMNS), HEADER)
        .otherwise(DATA)
    )
    opening = F.col("_metadata.file_block_start") == 0
    return spark.read.text(path).select(
        "value",
        F.input_file_name().alias(SOURCE_FILE),
        kind.alias(KIND),
        F.when(opening, F.monotonically_increasing_id()).alias(PLACE),
    )


def is_data() -> Column:
    return F.col(KIND) == DATA


def sound_files(lines: DataFrame) -> DataFrame:
    """Names of the files whose first line is the header; one row for each."""
    # Minima of numbers aggregate by hashing; the first kind itself would need a sort.
    header = F.when(F.col(KIND) == HEADER, F.col(PLACE))
    return (
        lines.filter(F.col(PLACE).isNotNull())
        .groupBy(SOURCE_FILE)
        .agg(F.min(PLACE).alias("first_line"), F.min(header).alias("first_header"))
        .filter("first_line = first_header")
        .select(SOURCE_FILE)
    )


def check_headers(lines: DataFrame, files: SnapshotFiles, report: str | None = None) -> None:
    """Fail unless each of the files has lines and its first one is the header.

    The error names a few files, says how many there are, and holds all as a DataFrame; ``report``
    gets them as JSON lines.
    """
    opened = sound_files(lines)
    number = len(files) - opened.count()
    if number == 0:
        return
    unsound = files.frame().join(opened, SOURCE_FILE, "left_anti")
    if report is not None:
        unsound.write.mode("overwrite").json(report)
        unsound = unsound.sparkSession.read.schema(unsound.schema).json(report)
    named = [row[0] for row in unsound.orderBy(SOURCE_FILE).take(_FILES_NAMED)]
    more = f" and {number - len(named)} more" if number > len(named) else ""
    listed = f", all listed in {report}" if report is not None else ""
    raise HeaderError(
        f"CSV header does not match required column order{listed} in {', '.join(named)}{more}",
        unsound,
    )


def parse_lines(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Twelve text columns per line, and the columns to keep.

    A line of the wrong width keeps its leading fields, a line with broken quoting keeps
    none; both keep the whole line in the corrupt-record column.
    """
    fields = split_fields(without_byte_order_mark(F.col("value")))
    sound = F.coalesce(F.size("fields") == len(SOURCE_COLUMNS), F.lit(False))
    return lines.withColumn("fields", fields).select(
        *(F.get("fields", F.lit(at)).alias(name) for at, name in enumerate(SOURCE_COLUMNS)),
        F.when(~sound, F.col("value")).alias(CORRUPT),
        SOURCE_FILE,
        *keep,
    )


def read_snapshot(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Check every header, then return the data lines as untyped rows (lazy).

    The check reads the files once.  A run that stages its input anyway checks the staged
    lines instead, see ``plans.publish``.
    """
    lines = snapshot_lines(spark, path)
    check_headers(lines, SnapshotFiles(spark, path))
    return parse_lines(lines.filter(is_data()))
