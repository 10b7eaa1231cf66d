"""Pick the current version of each order line and rank the superseded ones.

A key normally has a handful of versions, and a window per key ranks them.  A window has
to hold all versions of one key in one task, though, so keys with very many versions are
ranked another way: their rows are sorted across tasks by range, numbered in sorted
order, and the number of a key's first row is taken off.  Both ways give the same ranks.
"""

from __future__ import annotations

import math
import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tallygate.contract import ORDER_LINES, RECORD_HASH, SOURCE_FILE, SUPERSEDED

RANK = "dedup_rank"
TIED = "is_tied"
VERSION_KEYS = ("order_id", "line_id")

# Versions of one key that a single task ranks without trouble.
CROWD = 5_000_000
_FEWEST_BUCKETS = 4_096
_ROW_BITS = 33


def version_order() -> list[Column]:
    """Latest update first; ties go to the greatest hash, then to the first file."""
    return [
        F.col("updated_at").desc(),
        F.col(RECORD_HASH).desc(),
        F.col(SOURCE_FILE).asc_nulls_last(),
    ]


def with_hash_bytes(lines: DataFrame) -> DataFrame:
    """Record hashes as bytes, in the order of their text: half as long where rows are shuffled.

    Only for hashes that ``classify`` made; ``with_hash_text`` gives the text back.
    """
    return lines.withColumn(RECORD_HASH, F.unhex(RECORD_HASH))


def with_hash_text(lines: DataFrame) -> DataFrame:
    """Lower-case hex of record hashes that are bytes; others stay."""
    if not isinstance(lines.schema[RECORD_HASH].dataType, BinaryType):
        return lines
    return lines.withColumn(RECORD_HASH, F.lower(F.hex(RECORD_HASH)))


def rank_versions(
    lines: DataFrame,
    keys: Sequence[str] = VERSION_KEYS,
    order: Sequence[Column] | None = None,
    late: Callable[[DataFrame], DataFrame] | None = None,
    together: Sequence[str] | None = None,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Number the versions of each key from 1, the current one, by a window per key.

    late: adds columns of the order that follow from others, once rows are with their key.
    together: some of the keys, to shuffle by them alone; what such rows share then compresses.
    ties: columns that come before all late ones in the order. ``late`` gets a frame that says in
    ``TIED`` which rows share these with another of their key; it may leave its columns null elsewhere.
    """
    if late is not None or together is not None:
        lines = lines.repartition(*(together or keys))
    if late is not None:
        if ties:
            peers = F.count(F.lit(1)).over(Window.partitionBy(*keys, *ties))
            lines = lines.withColumn(TIED, peers > 1)
        lines = late(lines).drop(TIED)
    window = Window.partitionBy(*keys).orderBy(*(order or version_order()))
    return lines.withColumn(RANK, F.row_number().over(window))


def current_lines(ranked: DataFrame) -> DataFrame:
    return ranked.filter(F.col(RANK) == 1).select(*ORDER_LINES.fieldNames())


def superseded_lines(ranked: DataFrame) -> DataFrame:
    return ranked.filter(F.col(RANK) > 1).select(*SUPERSEDED.fieldNames())


def latest_lines(lines: DataFrame, keys: Sequence[str] = VERSION_KEYS) -> DataFrame:
    """Current versions only, for where the superseded ones are not needed.

    With the filter right on the rank, each task keeps one row per key that it has seen before
    anything is shuffled (a group limit), so no key is too large.
    """
    return current_lines(rank_versions(lines, keys))


@dataclass(frozen=True)
class FileNames:
    """What the names of a snapshot's files begin and end with, which need not be shuffled with each row."""

    first: str = ""
    last: str = ""

    @staticmethod
    def ends(lines: DataFrame) -> DataFrame:
        """Least and greatest name, forwards and backwards, and the least length, of all lines.

        A row for each file comes first, as least texts are not aggregated in place. Its lines are added up,
        so that the optimizer doesn't take that step for a needless one.
        """
        name = F.col(SOURCE_FILE)
        back = F.reverse(name)
        return lines.groupBy(name).agg(F.count(F.lit(1)).alias("file_lines")).agg(
            F.min(name), F.max(name), F.min(back), F.max(back), F.min(F.length(name)), F.sum("file_lines")
        )

    @classmethod
    def of(cls, lines: DataFrame) -> FileNames:
        """One pass; the least and the greatest name have no more in common than all of them."""
        least, most, back, forth, shortest, _ = cls.ends(lines).first()
        if least is None:
            return cls()
        first = os.path.commonprefix([least, most])
        last = os.path.commonprefix([back, forth])[: shortest - len(first)]
        return cls(first, last[::-1])

    def cut(self, lines: DataFrame) -> DataFrame:
        name = F.col(SOURCE_FILE)
        own = F.length(name) - F.lit(len(self.first) + len(self.last))
        return lines.withColumn(SOURCE_FILE, name.substr(F.lit(len(self.first) + 1), own))

    def whole(self, lines: DataFrame) -> DataFrame:
        return lines.withColumn(SOURCE_FILE, F.concat(F.lit(self.first), SOURCE_FILE, F.lit(self.last)))


# Crowded keys, or tasks that sort their rows, up to which a table of them is broadcast.
_MOST_BROADCAST = 100_000


def _small(frame: DataFrame, rows: int) -> DataFrame:
    """The frame, to be broadcast if its known number of rows allows it."""
    return F.broadcast(frame) if rows <= _MOST_BROADCAST else frame


@dataclass(frozen=True)
class CrowdedKeys:
    """Keys with more versions than one task should rank, and how many rows they hold."""

    keys: DataFrame
    rows: int
    number: int


def find_crowded(
    lines: DataFrame, rows: int, place: str, crowd: int, keys: Sequence[str] = VERSION_KEYS
) -> CrowdedKeys | None:
    """Keys with more than ``crowd`` versions, written to ``place``; None if there are none.

    Rows are first counted per hash bucket of the key, which combines to a small table in
    every task.  A crowded key makes its bucket crowded, so only keys of crowded buckets
    are counted one by one; without any, the second scan is skipped.  At most
    rows / crowd keys can qualify, which bounds both tables that are broadcast.
    """
    spark = lines.sparkSession
    buckets = max(_FEWEST_BUCKETS, 8 * math.ceil(rows / crowd))
    bucketed = lines.select(
        *keys, F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("key_bucket")
    )
    suspects = bucketed.groupBy("key_bucket").count().filter(F.col("count") > crowd)
    crowded = (
        bucketed.join(_small(suspects, rows // crowd), "key_bucket", "left_semi")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("versions"))
        .filter(F.col("versions") > crowd)
    )
    crowded.write.parquet(place)
    found = spark.read.schema(crowded.schema).parquet(place)
    held, number = found.agg(F.sum("versions"), F.count(F.lit(1))).first()
    return CrowdedKeys(found.select(*keys), held, number) if number else None


def rank_crowded(
    lines: DataFrame,
    crowded: CrowdedKeys,
    place: str,
    crowd: int,
    keys: Sequence[str] = VERSION_KEYS,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Ranks for the rows of crowded keys, without gathering a key in one task.

    The rows are range-partitioned by key, version order and a row number, so that even
    equal copies spread over tasks, sorted, and written to ``place`` with their position:
    task number and row within the task.  Reading them back fixes the positions.  Task
    sizes turn positions into one running number.
    """
    spark = lines.sparkSession
    schema = StructType([*lines.schema.fields, StructField("position", LongType())])
    tasks = max(2, math.ceil(2 * crowded.rows / crowd))
    by = [*(F.col(name) for name in keys), *(order or version_order()), F.col("row_id")]
    (
        lines.join(_small(crowded.keys, crowded.number), list(keys), "left_semi")
        .withColumn("row_id", F.monotonically_increasing_id())
        .repartitionByRange(tasks, *by)
        .sortWithinPartitions(*by)
        .drop("row_id")
        .withColumn("position", F.monotonically_increasing_id())
        .write.parquet(place)
    )
    placed = (
        spark.read.schema(schema)
        .parquet(place)
        .withColumn("task", F.shiftright("position", _ROW_BITS))
        .withColumn("row", F.col("position").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    )
    # One row per task of the sort above, so this window is small.
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("task")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("task", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    numbered = placed.join(_small(offsets, tasks), "task").withColumn(
        "number", F.col("offset") + F.col("row")
    )
    starts = numbered.groupBy(*keys).agg(F.min("number").alias("start"))
    return numbered.join(_small(starts, crowded.number), list(keys)).select(
        *lines.columns, (F.col("number") - F.col("start") + 1).cast("int").alias(RANK)
    )


def rank_at_scale(
    lines: DataFrame,
    rows: int,
    scratch: str,
    crowd: int = CROWD,
    keys: Sequence[str] = VERSION_KEYS,
    order: Sequence[Column] | None = None,
    late: Callable[[DataFrame], DataFrame] | None = None,
    together: Sequence[str] | None = None,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Ranks for any key sizes; ``lines`` should be read from storage, ``rows`` counts it.

    late, ties: see ``rank_versions``. Rows of crowded keys get these columns before they are sorted, all of them.
    together: see ``rank_versions``. Rows that would crowd a task by these alone are ranked apart, by all keys.
    """
    if together is not None:
        packed = find_crowded(lines, rows, f"{scratch}/packed_keys", crowd, together) if rows > crowd else None
        if packed is None:
            return rank_versions(lines, keys, order, late, together, ties)
        held = _small(packed.keys, packed.number)
        loose = lines.join(held, list(together), "left_anti")
        tight = lines.join(held, list(together), "left_semi")
        return rank_versions(loose, keys, order, late, together, ties).unionByName(
            rank_at_scale(tight, packed.rows, scratch, crowd, keys, order, late, ties=ties)
        )
    crowded = None
    if rows > crowd:
        crowded = find_crowded(lines, rows, f"{scratch}/crowded_keys", crowd, keys)
    if crowded is None:
        return rank_versions(lines, keys, order, late, ties=ties)
    sparse = lines.join(_small(crowded.keys, crowded.number), list(keys), "left_anti")
    whole = lines if late is None else late(lines)
    return rank_versions(sparse, keys, order, late, ties=ties).unionByName(
        rank_crowded(whole, crowded, f"{scratch}/crowded_lines", crowd, keys, order)
    )
