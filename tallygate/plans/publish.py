"""Publish one snapshot: stage, check, write.

The raw files are read and parsed once, into a staging dataset that is split by outcome.
Everything after that reads the staged columns it needs: the header check, the quarantine,
the version ranking, and the counts, which come from Parquet footers.  The ranked lines
are staged too, because the audit, the order lines and the daily sales all read them.
Nothing is published before the check that guards it has passed, and staged data outlives
a lost executor.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallygate.contract import (
    DAILY_SALES,
    DEFAULT_LIMITS,
    ORDER_LINES,
    RECORD_HASH,
    Limits,
)
from tallygate.functions.rules import Rule, contract_rules
from tallygate.operators.classify import (
    ACCEPTED,
    classify,
    rejected_rows,
    slim_lines,
    with_amounts,
    with_derived,
    with_hash,
    with_hash_to_rank,
    without_hash,
    without_typed_amounts,
)
from tallygate.operators.daily import daily_sales
from tallygate.operators.quality import (
    QualityError,
    RowCounts,
    RowDigest,
    RunMetrics,
    checked_batch_date,
    checked_ratio,
    daily_totals,
    digest_columns,
    reconcile_rows,
)
from tallygate.operators.versions import (
    CROWD,
    RANK,
    VERSION_KEYS,
    FileNames,
    rank_at_scale,
    superseded_lines,
    with_hash_text,
)
from tallygate.plans.attempts import (
    FAILED,
    KEPT,
    PUBLISHED,
    Attempt,
    begin_attempt,
    source_digest,
    staged_for_reuse,
)
from tallygate.session import settings, shuffles_for, use_contract_time
from tallygate.sources import files
from tallygate.sources.registry import announce_run, compact_registry
from tallygate.sources.runs import RunLayout, write_empty_manifest, write_manifest
from tallygate.sources.snapshot_csv import (
    KIND,
    PLACE,
    SnapshotFiles,
    check_headers,
    is_data,
    parse_lines,
    snapshot_lines,
)

OUTCOME = "outcome"
CURRENT = "is_current"

# Micros keep timestamps readable everywhere.  Splits of up to 64 MiB of compressed lines or columns
# keep the number of staged files down, and are small enough that no core waits long for the last ones.
# Half of a row is its hash in hex, which Spark's default codec leaves at 64 bytes and zstd halves.
_RUN = {
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.files.maxPartitionBytes": str(64 << 20),
}
# With a few files open per task, a split write needs no sort in front of it. A task that has opened
# this many sorts the rest of its rows all the same, so it is one more than the three outcomes.
_STAGING = {"spark.sql.maxConcurrentOutputFileWriters": "4"}

# The size of an order-line file to aim for, and directories that one task writes.
FILE_BYTES = 256 << 20
_DATES_PER_TASK = 4
# What a record hash takes in a file; staged lines have none.
_HASH_BYTES = 32
# An order's lines share much, so they are shuffled together.
ORDER_KEYS = ("order_id",)
# What a staged line takes in a task that sorts it is several times what it takes on storage, as
# that goes by how well the lines compress; so partitions are counted by lines.
_LINE_BYTES = 128
# Dates of a contract up to which a table with a row for each is broadcast.
_MOST_DATES = 100_000


@dataclass(frozen=True)
class Staged:
    """A dataset on storage, split into one directory per value of a column."""

    path: str
    schema: StructType
    split: str

    @classmethod
    def write(cls, frame: DataFrame, path: str, split: str) -> Staged:
        with settings(frame.sparkSession, _STAGING):
            frame.write.partitionBy(split).parquet(path)
        return cls(path, frame.schema, split)

    def read(self, spark: SparkSession, part: str | None = None) -> DataFrame:
        whole = spark.read.schema(self.schema).parquet(self.path)
        return whole if part is None else whole.filter(F.col(self.split) == part)

    def counts(self, spark: SparkSession) -> dict[str, int]:
        """Rows per part; no data column is read."""
        return {row[0]: row[1] for row in self.read(spark).groupBy(self.split).count().collect()}


def _stage_lines(
    spark: SparkSession,
    source: str | Sequence[str],
    path: str,
    rules: Sequence[Rule],
    limits: Limits,
    given: RowDigest,
) -> Staged:
    """Parse and classify all lines; header and blank lines stay only for the check."""
    kept = (KIND, PLACE)
    lines = snapshot_lines(spark, source)
    classified = classify(parse_lines(lines, kept), rules, limits, kept)
    accepted = F.col(ACCEPTED)
    outcome: Column = F.when(~is_data(), "skipped").when(accepted, "accepted").otherwise("rejected")
    needed = is_data() | F.col(PLACE).isNotNull()
    lines = without_typed_amounts(classified).withColumn(OUTCOME, outcome).filter(needed)
    return Staged.write(without_hash(given.observe(lines, is_data())), path, split=OUTCOME)


def _stage_ranked(
    spark: SparkSession, lines: DataFrame, rows: int, scratch: str, crowd: int, names: FileNames
) -> Staged:
    def late(gathered: DataFrame) -> DataFrame:
        return with_hash_to_rank(names.whole(gathered))

    # Few lines have a version of the same time, and hashes decide between those alone.
    ranked = rank_at_scale(
        names.cut(lines), rows, scratch, crowd, late=late, together=ORDER_KEYS, ties=("updated_at",)
    )
    is_current = F.when(F.col(RANK) == 1, "yes").otherwise("no")
    ranked = ranked.drop(RECORD_HASH).withColumn(CURRENT, is_current)
    return Staged.write(ranked, f"{scratch}/ranked", CURRENT)


def _kept_ranked(spark: SparkSession, lines: str, accepted: int) -> Staged | None:
    """The ranked lines beside kept ones, if they were written to the end and hold every accepted row."""
    path = f"{lines.removesuffix('/lines')}/ranked"
    if not files.exists(spark, f"{path}/_SUCCESS"):
        return None
    ranked = Staged(path, spark.read.parquet(path).schema, CURRENT)
    return ranked if sum(ranked.counts(spark).values()) == accepted else None


def date_shares(
    lines: DataFrame, rows: int, size: int, limits: Limits, file_bytes: int = FILE_BYTES
) -> tuple[DataFrame, DataFrame]:
    """Into how many shares of ``file_bytes`` each order date goes, and the same to be joined."""
    share_rows = max(1, math.floor(file_bytes * rows / max(1, size)))
    dates = lines.groupBy("order_date").agg(F.count(F.lit(1)).alias("date_rows")).withColumn(
        "shares", F.ceil(F.col("date_rows") / share_rows)
    )
    # The contract's range of dates bounds the table that is broadcast.
    return dates, F.broadcast(dates) if limits.order_days() <= _MOST_DATES else dates


def write_order_lines(
    lines: DataFrame,
    rows: int,
    size: int,
    path: str,
    limits: Limits,
    file_bytes: int = FILE_BYTES,
    digest: RowDigest | None = None,
    names: FileNames = FileNames(),
) -> None:
    """One directory per order date, with as few files as the size of the date allows.

    Rows are counted per date first, a table of at most ``limits.order_days()`` rows.  A date gets
    as many shares as it has files of ``file_bytes``, and the rows are dealt out by date and
    share, so a date has at most that many files however many cores there are.

    Record hashes may be bytes, see ``with_hash_bytes``; the files hold their text. Slim lines with their
    ``order_date`` will do, so that what follows from other columns need not be shuffled; the files hold it.

    size: bytes that the ``rows`` lines take on storage. digest: filled with the rows written.
    names: what the lines' file names have in common; it is not shuffled.
    """
    digest = RowDigest("order lines") if digest is None else digest
    dates, small = date_shares(lines, rows, size, limits, file_bytes)

    def whole(dealt: DataFrame) -> DataFrame:
        dealt = with_hash_text(with_derived(names.whole(dealt)).select(*ORDER_LINES.fieldNames()))
        return digest.observe(dealt)

    lines = names.cut(lines)
    if rows == 0 or (shares := dates.agg(F.sum("shares")).first()[0]) is None:
        whole(lines).write.partitionBy("order_date").parquet(path)
        return
    by = [name for name in (RECORD_HASH, *VERSION_KEYS) if name in lines.columns]
    dealt = (
        lines.join(small.select("order_date", "shares"), "order_date")
        .withColumn("share", F.pmod(F.xxhash64(*by), F.col("shares")))
        .repartition(math.ceil(shares / _DATES_PER_TASK), "order_date", "share")
    )
    # Sorted by share as well, so that a task writes one file for each, date by date.
    ordered = dealt.sortWithinPartitions("order_date", "share").select(*lines.columns)
    whole(ordered).write.partitionBy("order_date").parquet(path)


def build_run(
    spark: SparkSession,
    source: str | Sequence[str],
    root: str,
    run_id: str,
    max_reject_ratio: float = 0.25,
    rules: Sequence[Rule] | None = None,
    limits: Limits = DEFAULT_LIMITS,
    crowd: int = CROWD,
    keep_staging: bool = False,
    reuse: str | None = None,
) -> RunMetrics:
    """Write all datasets of a run, without markers; see ``publish_snapshot``.

    Quarantine and audit are written even if a gate then fails. With ``keep_staging``, the lines
    staged by an attempt that a gate turns down stay, and ``reuse`` names such an attempt. Where it has
    ranked them all, they aren't ranked again.
    """
    layout = RunLayout(root, run_id)
    checked_ratio(max_reject_ratio)
    rules = contract_rules(limits) if rules is None else list(rules)
    use_contract_time(spark)
    spelled = f"{[(rule.reason, str(rule.broken)) for rule in rules]} {limits} without hashes"
    by = hashlib.sha256(spelled.encode()).hexdigest()
    digest = source_digest(spark, source)
    lines = None if reuse is None else f"{staged_for_reuse(spark, root, reuse, digest, by)}/lines"
    attempt = begin_attempt(spark, layout, digest, by)
    outcome = FAILED
    try:
        with settings(spark, _RUN):
            metrics = _build(
                spark, source, layout, attempt.staging, max_reject_ratio, rules, limits, crowd, lines
            )
        outcome = PUBLISHED
        if lines is not None:
            Attempt(layout, reuse, lines.removesuffix("/lines")).end(spark, PUBLISHED)
        return metrics
    except QualityError:
        outcome = KEPT if keep_staging and lines is None else FAILED
        raise
    finally:
        attempt.end(spark, outcome)


def _staged(
    spark: SparkSession,
    source: str | Sequence[str],
    layout: RunLayout,
    path: str,
    rules: Sequence[Rule],
    limits: Limits,
    reuse: str | None,
) -> tuple[Staged, tuple]:
    """The classified lines on storage, and the digest of the rows that were given."""
    if reuse is not None:
        staged = Staged(reuse, spark.read.parquet(reuse).schema, OUTCOME)
        return staged, tuple(with_hash(staged.read(spark)).agg(*digest_columns(is_data())).first())
    # Opening lines are looked at before any row is parsed; filters keep the rest unread
    # where a file has more than one split.
    opening = snapshot_lines(spark, source).filter(F.col(PLACE).isNotNull())
    check_headers(opening, SnapshotFiles(spark, source), f"{layout.manifests}/bad_headers")
    given = RowDigest(f"given {path}")
    staged = _stage_lines(spark, source, path, rules, limits, given)
    return staged, given.get()


def _build(
    spark: SparkSession,
    source: str | Sequence[str],
    layout: RunLayout,
    staging: str,
    most: float,
    rules: Sequence[Rule],
    limits: Limits,
    crowd: int,
    reuse: str | None,
) -> RunMetrics:
    staged, given = _staged(spark, source, layout, f"{staging}/lines", rules, limits, reuse)
    digests = {name: RowDigest(f"{name} {staging}") for name in ("rejected", "current", "superseded")}
    outcomes = staged.counts(spark)
    accepted, rejected = (outcomes.get(name, 0) for name in ("accepted", "rejected"))
    turned_away = rejected_rows(with_hash(staged.read(spark, "rejected")))
    turned_away = digests["rejected"].observe(turned_away)
    turned_away.write.parquet(layout.quarantine)
    with settings(spark, shuffles_for(spark, max(files.size(spark, staged.path), _LINE_BYTES * accepted))):
        slim = slim_lines(staged.read(spark, "accepted"))
        names = FileNames.of(slim)
        ranked = _kept_ranked(spark, reuse, accepted) if reuse is not None and accepted else None
        if ranked is None:
            ranked = _stage_ranked(spark, slim, accepted, staging, crowd, names)
        return _check_and_write(
            spark, ranked, accepted, rejected, layout, staging, most, limits, given, digests, names
        )


def _check_and_write(
    spark: SparkSession,
    ranked: Staged,
    accepted: int,
    rejected: int,
    layout: RunLayout,
    staging: str,
    most: float,
    limits: Limits,
    given: tuple,
    digests: dict[str, RowDigest],
    names: FileNames,
) -> RunMetrics:
    older = superseded_lines(with_derived(ranked.read(spark, "no")))
    older = digests["superseded"].observe(older)
    older.write.parquet(layout.superseded)
    versions = ranked.counts(spark)
    counts = RowCounts(accepted + rejected, rejected, versions.get("yes", 0), versions.get("no", 0))
    counts.reconcile()
    ratio = counts.reject_ratio(most)

    latest = ranked.read(spark, "yes")
    held = files.size(spark, ranked.path) * counts.current // max(1, accepted)
    held += _HASH_BYTES * counts.current
    dated = latest.drop(RANK, CURRENT).withColumn("order_date", F.to_date("order_timestamp"))
    write_order_lines(
        dated, counts.current, held, layout.order_lines, limits, digest=digests["current"], names=names
    )
    reconcile_rows(given, [digest.get() for digest in digests.values()])

    staged_daily = f"{staging}/daily"
    _, shares = date_shares(dated, counts.current, held, limits)
    daily_sales(dated, shares, late=with_amounts).write.parquet(staged_daily)
    daily = spark.read.schema(DAILY_SALES).parquet(staged_daily)
    totals = daily_totals(daily)
    totals.check()
    daily.write.parquet(layout.daily_sales)
    return RunMetrics(
        layout.run_id,
        counts.given,
        counts.rejected,
        counts.superseded,
        counts.current,
        totals.groups,
        ratio,
        str(totals.net_amount),
    )


def _now() -> str:
    return datetime.now(UTC).isoformat()


def checked_source_date(source: str | Sequence[str], batch_date: str) -> None:
    """A path that names a batch date has to name the one that is published."""
    for path in [source] if isinstance(source, str) else source:
        named = re.findall(r"(?:^|/)batch_date=([^/]*)", path)
        if named and named[-1] != batch_date:
            raise ValueError(f"{path} holds another batch than {batch_date}")


def reserve_run(spark: SparkSession, layout: RunLayout, batch_date: str | None) -> None:
    """Take the run id; refuse one that has left any output behind."""
    taken: Iterable[str] = (path for path in layout.outputs() if files.exists(spark, path))
    for path in taken:
        raise files.AlreadyExistsError(f"Run {layout.run_id} already has output: {path}")
    files.write_once(
        spark,
        layout.marker("started"),
        {"run_id": layout.run_id, "batch_date": batch_date, "started_at": _now()},
    )


def publish_snapshot(
    spark: SparkSession,
    source: str | Sequence[str],
    root: str,
    run_id: str,
    batch_date: str | None = None,
    max_reject_ratio: float = 0.25,
    rules: Sequence[Rule] | None = None,
    limits: Limits = DEFAULT_LIMITS,
    crowd: int = CROWD,
    keep_staging: bool = False,
    reuse: str | None = None,
) -> RunMetrics:
    """Build a run and mark it: started, then its load manifest and success, or failure.

    Readers go by the success marker, which is written last. See ``build_run`` for the last two.
    """
    layout = RunLayout(root, run_id)
    if batch_date is not None:
        checked_batch_date(batch_date)
        checked_source_date(source, batch_date)
    checked_ratio(max_reject_ratio)
    reserve_run(spark, layout, batch_date)
    try:
        metrics = build_run(
            spark, source, root, run_id, max_reject_ratio, rules, limits, crowd, keep_staging, reuse
        )
        if metrics.gold_rows:
            write_manifest(spark, layout.daily_sales, DAILY_SALES, layout.load_manifest)
        else:
            write_empty_manifest(spark, layout.load_manifest)
        announce_run(spark, layout)
        files.write_once(
            spark,
            layout.marker("success"),
            {**metrics.as_dict(), "batch_date": batch_date, "completed_at": _now()},
        )
    except Exception:
        files.write_once(
            spark, layout.marker("failure"), {"run_id": run_id, "failed_at": _now()}
        )
        raise
    compact_registry(spark, root)
    return metrics
