"""Gates between staging and publication, and guards on the parameters of a run."""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass
from datetime import date
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallygate.contract import RECORD_HASH, SOURCE_FILE
from tallygate.operators.daily import overflowed

# Fixed value: the form of a run id.
_RUN_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9_-]{0,127}")
_ISO_DATE = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}")


class QualityError(ValueError):
    """The snapshot must not be published; its quarantine and audit stay available."""


@dataclass(frozen=True)
class RunMetrics:
    run_id: str
    input_rows: int
    rejected_rows: int
    duplicate_rows: int
    valid_rows: int
    gold_rows: int
    reject_ratio: float
    net_amount: str

    def as_dict(self) -> dict[str, Any]:
        return asdict(self)


@dataclass(frozen=True)
class RowCounts:
    """How the input rows of a run fall into its three outputs."""

    given: int
    rejected: int
    current: int
    superseded: int

    def reconcile(self) -> None:
        """Every input row must be in exactly one output."""
        if self.given != self.rejected + self.current + self.superseded:
            raise QualityError(
                f"Rows do not reconcile: {self.given} in, {self.rejected} rejected, "
                f"{self.current} current, {self.superseded} superseded"
            )

    def reject_ratio(self, most: float) -> float:
        """The share of rejected rows; fails if it exceeds the limit or nothing is left."""
        checked_ratio(most)
        if not self.given:
            raise QualityError("An empty snapshot cannot be published")
        ratio = self.rejected / self.given
        if ratio > most or not self.current:
            raise QualityError(
                f"Too few sound rows: {self.rejected} of {self.given} rejected "
                f"(ratio {ratio:.4f}, at most {most}), {self.current} current"
            )
        return ratio


class RowDigest:
    """The rows of a dataset as a multiset: their number and the sums of two hashes of each.

    Order and partitioning don't matter, and sums of parts add up. A dataset that is written anyway
    gives its digest in the same pass. Rows are told apart by their record hash and their file, so
    a row that is swapped for another shows, even where all counts agree.
    """

    def __init__(self, name: str):
        self._metrics = Observation(name)

    def observe(self, frame: DataFrame, counted: Column | None = None) -> DataFrame:
        """The same rows; the action that writes them fills the digest, of rows ``counted`` alone."""
        return frame.observe(self._metrics, *digest_columns(counted))

    def get(self) -> tuple[int, Decimal, Decimal]:
        found = self._metrics.get
        return found["row_count"], found["first_sum"], found["second_sum"]


def digest_columns(counted: Column | None = None) -> list[Column]:
    """Aggregates of a digest: row_count, first_sum and second_sum."""
    counted = F.lit(True) if counted is None else counted

    def total(*columns: Column | str) -> Column:
        hashed = F.when(counted, F.xxhash64(*columns)).cast("decimal(38,0)")
        return F.coalesce(F.sum(hashed), F.lit(0)).cast("decimal(38,0)")

    return [
        F.count_if(counted).alias("row_count"),
        total(RECORD_HASH, SOURCE_FILE).alias("first_sum"),
        total(F.lit("second"), SOURCE_FILE, RECORD_HASH).alias("second_sum"),
    ]


def reconcile_rows(given: tuple, parts: list[tuple]) -> None:
    """The parts together must hold every given row as often as it was given, and no other."""
    together = tuple(map(sum, zip(*parts)))
    if together != tuple(given):
        raise QualityError(f"Rows do not reconcile: {given} in, {together} in the outputs together")


@dataclass(frozen=True)
class DailyTotals:
    groups: int
    overflowed: int
    net_amount: Decimal

    def check(self) -> None:
        if self.overflowed:
            raise QualityError(f"Totals of {self.overflowed} daily groups are out of range")


def daily_totals(daily: DataFrame) -> DailyTotals:
    """Group count, overflow count and grand total, in one pass."""
    row = daily.agg(
        F.count(F.lit(1)),
        F.count_if(overflowed()),
        F.coalesce(F.try_sum("net_amount"), F.lit(0)).cast("decimal(28,2)"),
    ).first()
    return DailyTotals(*row)


def checked_run_id(value: str) -> str:
    if not isinstance(value, str) or not _RUN_ID.fullmatch(value):
        raise ValueError("run_id takes 1 to 128 letters, digits, underscores or hyphens")
    return value


def checked_batch_date(value: str) -> str:
    if not isinstance(value, str) or not _ISO_DATE.fullmatch(value):
        raise ValueError("batch_date takes the form YYYY-MM-DD")
    return date.fromisoformat(value).isoformat()


def checked_ratio(value: float) -> float:
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    if not number or not 0 <= value <= 1:
        raise ValueError("max_reject_ratio takes a number from 0 to 1")
    return value
