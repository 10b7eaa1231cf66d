"""Daily sales: completed order lines per order date, country and category."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygate.contract import DAILY_SALES, MONEY

GRAIN = ("order_date", "country", "category")
MEASURES = ("gross_amount", "discount_amount", "net_amount")


def _exact_total(name: str) -> Column:
    """Sum in the wider accumulator; null where the total does not fit the money type."""
    return F.try_sum(name).try_cast(MONEY).alias(name)


def daily_sales(
    lines: DataFrame,
    shares: DataFrame | None = None,
    late: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Aggregate current lines.

    ``order_count`` is distinct within a group and does not add up over categories.  Spark
    removes duplicate orders before the shuffle and again after it, so a large group is
    spread by order.  A total out of range becomes null, which ``overflowed`` finds.

    shares: into how many shares each ``order_date`` goes. Lines are then shuffled once, by date and
    share, and an order of a date is all in one share, so that the shares' order counts add up.
    late: adds columns that follow from others, once the lines are shuffled.
    """
    completed = lines.filter(F.col("status") == "COMPLETED")
    if shares is not None:
        return _by_share(completed, shares, late)
    if late is not None:
        completed = late(completed)
    return completed.groupBy(*GRAIN).agg(*_counts(), *map(_exact_total, MEASURES)).select(*DAILY_SALES.fieldNames())


def _counts() -> list[Column]:
    return [
        F.count_distinct("order_id").alias("order_count"),
        F.count(F.lit(1)).alias("line_count"),
        F.try_sum(F.col("quantity").cast("long")).alias("units"),
    ]


def _added_up(name: str) -> Column:
    """The sum of the shares' totals; null where one of them did not fit, as null totals would be left out."""
    return F.when(F.bool_and(F.col(name).isNotNull()), F.try_sum(name))


def _by_share(
    completed: DataFrame, shares: DataFrame, late: Callable[[DataFrame], DataFrame] | None
) -> DataFrame:
    needed = {*GRAIN, "order_id", "quantity", "status", "unit_price", *MEASURES}
    slim = completed.select(*(name for name in completed.columns if name in needed))
    share = F.pmod(F.xxhash64("order_id"), F.coalesce("shares", F.lit(1)))
    dealt = (
        slim.join(shares.select("order_date", "shares"), "order_date", "left")
        .select(*slim.columns, share.alias("share"))
        .repartition("order_date", "share")
    )
    parts = (
        (dealt if late is None else late(dealt))
        .groupBy(*GRAIN, "share")
        .agg(*_counts(), *(F.try_sum(name).alias(name) for name in MEASURES))
    )
    return (
        parts.groupBy(*GRAIN)
        .agg(
            F.sum("order_count").alias("order_count"),
            F.sum("line_count").alias("line_count"),
            _added_up("units").alias("units"),
            *(_added_up(name).try_cast(MONEY).alias(name) for name in MEASURES),
        )
        .select(*DAILY_SALES.fieldNames())
    )


def overflowed() -> Column:
    """True for a daily group with a total that did not fit."""
    return F.greatest(*(F.col(name).isNull() for name in ("units", *MEASURES)))


def consistent() -> Column:
    """Row invariants of published daily sales; false or null marks an invalid row."""
    known = F.least(*(F.col(name).isNotNull() for name in DAILY_SALES.fieldNames()))
    counts = (
        (F.col("order_count") > 0)
        & (F.col("order_count") <= F.col("line_count"))
        & (F.col("line_count") <= F.col("units"))
    )
    money = F.least(*(F.col(name) >= 0 for name in MEASURES))
    balanced = F.col("net_amount") == F.col("gross_amount") - F.col("discount_amount")
    return F.coalesce(known & counts & money & balanced, F.lit(False))


def summary(daily: DataFrame) -> DataFrame:
    """One row: groups, lines, units, net revenue and invalid rows; zeros when empty."""

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    return daily.agg(
        F.count(F.lit(1)).alias("gold_rows"),
        total("line_count").alias("line_count"),
        total("units").alias("units"),
        total("net_amount").cast("decimal(28,2)").alias("net_revenue"),
        F.count_if(~consistent()).alias("invalid_rows"),
    )
