"""Report queries over a published run and over the mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygate.contract import DEFAULT_LIMITS, Limits


def _percent(part: Column, whole: Column) -> Column:
    """Two-digit percentage; null where the whole is zero."""
    share = F.lit(100) * part / F.nullif(whole, F.lit(0).cast("decimal(28,2)"))
    return F.round(share, 2).cast("decimal(18,2)")


def sales_by_day_country(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy("order_date", "country")
        .agg(F.sum("net_amount").alias("net_revenue"), F.sum("units").alias("units"))
        .orderBy("order_date", "country")
    )


def orders_by_day(lines: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Orders per day from order lines, where they can be told apart across categories.

    Cancelled lines count as lines and carry no money.
    """
    first, last = (
        F.lit(day).cast("date") for day in (limits.first_order_date, limits.last_order_date)
    )
    return (
        lines.filter(F.col("order_date").between(first, last))
        .groupBy("order_date")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.count(F.lit(1)).alias("order_lines"),
            F.sum("net_amount").alias("net_revenue"),
        )
        .orderBy("order_date")
    )


def category_performance(daily: DataFrame) -> DataFrame:
    """Revenue and discount share of each category within its country, best first."""
    return (
        daily.groupBy("country", "category")
        .agg(
            F.sum("net_amount").alias("net_revenue"),
            F.sum("discount_amount").alias("discounts"),
            _percent(F.sum("discount_amount"), F.sum("gross_amount")).alias("discount_percent"),
        )
        .orderBy("country", F.col("net_revenue").desc())
    )


def sales_by_day(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy("order_date")
        .agg(
            F.sum("line_count").alias("line_count"),
            F.sum("units").alias("units"),
            F.sum("net_amount").alias("net_revenue"),
        )
        .orderBy("order_date")
    )


def category_revenue_share(daily: DataFrame) -> DataFrame:
    """Each category's part of all revenue.

    The grand total is a scalar subquery: a window over everything would bring all
    categories into one task.
    """
    total = daily.agg(F.sum("net_amount")).scalar()
    return (
        daily.groupBy("category")
        .agg(F.sum("net_amount").alias("net_revenue"))
        .withColumn("revenue_share_percent", _percent(F.col("net_revenue"), total))
        .orderBy(F.col("net_revenue").desc())
    )


def mart_integrity(mart: DataFrame) -> DataFrame:
    """One row; a mart that is not empty must hold exactly one snapshot."""
    unbalanced = F.col("net_amount") != F.col("gross_amount") - F.col("discount_amount")
    return mart.agg(
        F.count(F.lit(1)).alias("gold_rows"),
        F.count_distinct("source_run_id").alias("snapshot_count"),
        F.sum("net_amount").alias("net_revenue"),
        F.sum(F.when(unbalanced, 1).otherwise(0)).alias("inconsistent_rows"),
    )


def rejects_by_reason(quarantine: DataFrame) -> DataFrame:
    """How many rejected rows carry each reason; a row counts once per reason."""
    return (
        quarantine.select(F.explode("validation_errors").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rejected_rows"))
        .orderBy(F.col("rejected_rows").desc(), "reason")
    )
