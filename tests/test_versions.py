from __future__ import annotations

import re
from decimal import ROUND_DOWN, Decimal

import pytest
from pyspark.sql import functions as F

from shapes import BOOK, frame
from tallygate.operators.classify import accepted_lines, classify, slim_lines, with_hash_to_rank, without_hash
from tallygate.operators.daily import daily_sales, overflowed
from tallygate.operators.versions import (
    RANK,
    TIED,
    current_lines,
    find_crowded,
    latest_lines,
    rank_at_scale,
    rank_versions,
    superseded_lines,
)


def lines_of(spark, *changes):
    return accepted_lines(classify(frame(spark, *changes)))


def shown(ranked):
    return sorted(
        (row.order_id, row.line_id, row[RANK], row._record_hash) for row in ranked.collect()
    )


def test_the_latest_valid_version_wins(spark):
    hours = [5, 1, 4, 2, 3]
    lines = lines_of(
        spark,
        *({"line_id": "8", "quantity": str(10 + h), "updated_at": f"2023-05-18T0{h}:00:00"} for h in hours),
        {"line_id": "8", "quantity": "none", "updated_at": "2023-05-19T00:00:00"},
        {"line_id": "9"},
        {"line_id": "9", "updated_at": "2023-06-01T00:00:00", "status": "cancelled"},
    )
    ranked = rank_versions(lines)
    winners = {row.line_id: row for row in current_lines(ranked).collect()}
    assert winners["8"].quantity == 15
    assert winners["8"].net_amount == 15 * Decimal(BOOK["unit_price"]) - Decimal(BOOK["discount_amount"])
    assert winners["9"].status == "CANCELLED" and winners["9"].net_amount == 0
    older = [(row.line_id, row.quantity, row[RANK]) for row in superseded_lines(ranked).collect()]
    assert sorted(older) == [("8", 10 + h, 6 - h) for h in (1, 2, 3, 4)] + [("9", 4, 2)]
    (sales,) = daily_sales(current_lines(ranked)).collect()
    assert (sales.order_count, sales.line_count, sales.units) == (1, 1, 15)


def test_ties_go_to_the_greatest_hash_then_the_first_file(spark):
    lines = lines_of(spark, {"quantity": "1"}, {"quantity": "2"}, {"quantity": "3"})
    for parts in (1, 3):
        ranked = rank_versions(lines.repartition(parts)).orderBy(RANK).collect()
        hashes = [row._record_hash for row in ranked]
        assert hashes == sorted(hashes, reverse=True)
    copies = lines_of(spark, {}, {}, {}).coalesce(1).withColumn(
        "_source_file", F.element_at(F.array(F.lit(None), F.lit("b"), F.lit("a")),
                                     (F.monotonically_increasing_id() + 1).cast("int"))
    )
    files = [row._source_file for row in rank_versions(copies).orderBy(RANK).collect()]
    assert files == ["a", "b", None]
    assert latest_lines(copies).first()._source_file == "a"


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of all rows, most of them equal copies; a second is busy too."""
    base = lines_of(spark, {})
    numbered = spark.range(3000).select(
        F.when(F.col("id") < 1000, "HOT").when(F.col("id") < 1400, "BUSY")
        .otherwise(F.concat(F.lit("N"), F.col("id") % 900)).alias("order_id"),
        F.when(F.col("id") < 700, 0).otherwise(F.col("id") % 7).alias("age"),
        F.when(F.col("id") < 700, 1).otherwise(F.col("id") % 5).alias("shape"),
    )
    return numbered.crossJoin(F.broadcast(base.drop("order_id"))).select(
        "order_id",
        *(name for name in base.columns if name not in
          ("order_id", "updated_at", "_record_hash", "_source_file")),
        (F.col("updated_at") - F.make_dt_interval(F.lit(0), F.lit(0), F.col("age"))).alias(
            "updated_at"),
        F.sha2(F.col("shape").cast("string"), 256).alias("_record_hash"),
        F.lit(None).cast("string").alias("_source_file"),
    ).select(*base.columns).repartition(6)


def test_crowded_keys_are_found_exactly(spark, skewed, tmp_path):
    crowded = find_crowded(skewed, 3000, str(tmp_path / "a"), crowd=399)
    assert {row.order_id for row in crowded.keys.collect()} == {"HOT", "BUSY"}
    assert crowded.rows == 1400
    assert find_crowded(skewed, 3000, str(tmp_path / "b"), crowd=1000) is None


@pytest.mark.parametrize("crowd", [50, 399, 400, 5000])
def test_ranks_do_not_depend_on_how_crowded_keys_are_handled(spark, skewed, tmp_path, crowd):
    ranked = rank_at_scale(skewed, 3000, str(tmp_path), crowd)
    assert shown(ranked) == shown(rank_versions(skewed))


def test_no_task_holds_a_crowded_key(spark, skewed, tmp_path):
    rank_at_scale(skewed, 3000, str(tmp_path), crowd=399).collect()
    placed = spark.read.parquet(f"{tmp_path}/crowded_lines")
    sizes = placed.groupBy(F.shiftright("position", 33)).count().collect()
    assert len(sizes) > 2
    assert max(row["count"] for row in sizes) < 399


def test_latest_lines_equal_the_first_ranks(spark, skewed):
    assert sorted(latest_lines(skewed).collect()) == sorted(
        current_lines(rank_versions(skewed)).collect()
    )


def test_latest_lines_cut_keys_down_before_the_shuffle(spark, skewed):
    plan = latest_lines(skewed)._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:] and "Partial" in plan[exchange:]


def test_orders_are_distinct_within_a_group(spark):
    changes = [
        {"order_id": f"D{n % 4}", "line_id": str(n), "country": ("NO", "JP")[n % 3 % 2]} for n in range(14)
    ]
    groups = {row.country: row for row in daily_sales(lines_of(spark, *changes)).collect()}
    for country in ("NO", "JP"):
        own = [c for c in changes if c["country"] == country]
        row = groups[country]
        assert row.order_count == len({c["order_id"] for c in own})
        assert (row.line_count, row.units) == (len(own), len(own) * int(BOOK["quantity"]))


def test_totals_out_of_range_become_null_and_are_found(spark):
    most = Decimal(10) ** 16 - Decimal("0.01")
    share = (most / 4).quantize(Decimal("0.01"), ROUND_DOWN)
    worth = {"quantity": "1", "discount_amount": "0"}
    fits = [{"line_id": str(n), "unit_price": str(share), **worth} for n in range(4)]
    over = [{**c, "country": "NO"} for c in fits] + [{"line_id": "4", "country": "NO", "unit_price": "1", **worth}]
    rows = {row.country: row for row in daily_sales(lines_of(spark, *fits, *over)).collect()}
    assert rows["PT"].gross_amount == rows["PT"].net_amount == 4 * share
    assert rows["NO"].gross_amount is None and rows["NO"].net_amount is None
    assert rows["NO"].discount_amount == 0 and rows["NO"].line_count == 5
    daily = daily_sales(lines_of(spark, *fits, *over))
    assert [row.country for row in daily.filter(overflowed()).collect()] == ["NO"]


def test_all_cancelled_lines_make_no_sales(spark):
    assert daily_sales(lines_of(spark, {"status": "CANCELLED"})).count() == 0


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("crowd", [50, 399, 400, 5000])
def test_ranks_do_not_depend_on_what_is_shuffled_together(spark, skewed, tmp_path, crowd):
    ranked = rank_at_scale(skewed, 3000, str(tmp_path), crowd, together=("order_id",))
    assert shown(ranked) == shown(rank_versions(skewed))
    assert spark.read.parquet(f"{tmp_path}/packed_keys").count() > 0 if crowd < 3000 else True


def test_lines_of_an_order_are_shuffled_once_and_together(spark):
    changes = [{"order_id": f"N{n % 9}", "line_id": str(n)} for n in range(60)]
    ranked = rank_versions(lines_of(spark, *changes), together=("order_id",))
    places = ranked.select("order_id", F.spark_partition_id().alias("task")).distinct()
    assert places.count() == 9
    assert plan(ranked).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("crowd", [50, 399, 5000])
def test_hashes_are_worked_out_for_tied_lines_alone(spark, skewed, tmp_path, crowd):
    """Every line was hashed again to be ranked, where only versions of the same time need it."""
    changes = [{"order_id": f"T{n // 3}", "updated_at": f"2030-01-0{1 + n % 3 // 2}T00:00:00", "category": f"c{n}"} for n in range(12)]
    lines = skewed.unionByName(lines_of(spark, *changes, {"order_id": "alone"}))
    hashes = lines.select("*", F.col("_record_hash").alias("text")).drop("_record_hash")

    def late(gathered):
        value = F.col("text")
        return gathered.withColumn("_record_hash", F.when(F.col(TIED), value) if TIED in gathered.columns else value)

    ranked = rank_at_scale(
        hashes, 3013, str(tmp_path), crowd, late=late, together=("order_id",), ties=("updated_at",)
    )
    assert TIED not in ranked.columns
    found = ranked.withColumn("_record_hash", F.col("text"))
    assert shown(found) == shown(rank_versions(lines))
    named = {row.order_id: row._record_hash for row in ranked.filter("order_id LIKE 'T%' OR order_id = 'alone'").collect() if row[RANK] == 1}
    assert named == {"T0": None, "T1": None, "T2": None, "T3": None, "alone": None}


def test_hashes_of_untied_lines_are_left_out_of_the_plan_of_a_run(spark):
    lines = without_hash(classify(frame(spark, {})))
    ranked = rank_versions(slim_lines(lines), late=with_hash_to_rank, together=("order_id",), ties=("updated_at",))
    text = ranked._jdf.queryExecution().optimizedPlan().toString()
    # the hash itself, once, behind the condition
    assert re.search(r"CASE WHEN \S*is_tied\S* THEN unhex\(sha2|CASE WHEN \(\S+ > 1\) THEN unhex\(sha2", text), text


def test_daily_sales_by_shares_are_the_same_in_one_shuffle_of_lines(spark):
    changes = [
        {
            "order_id": f"N{n % 7}", "line_id": str(n), "category": ("Lamps", "Music")[n % 3 % 2], "quantity": str(1 + n),
            "order_timestamp": f"2023-05-{17 + n % 2}T18:04:09", "status": "CANCELLED" if n % 11 == 3 else "COMPLETED",
        }
        for n in range(60)
    ]
    lines = lines_of(spark, *changes)
    shares = spark.sql("SELECT DATE'2023-05-17' AS order_date, 4L AS shares")  # the other date has none
    by_share = daily_sales(lines, shares)
    assert sorted(by_share.collect()) == sorted(daily_sales(lines).collect())
    assert by_share.dtypes == daily_sales(lines).dtypes
    spread = [part for part in plan(by_share).splitlines() if "Exchange hashpartitioning" in part]
    assert not any("order_id" in part for part in spread)


def test_totals_out_of_range_are_null_by_shares_as_well(spark):
    high = {"quantity": "1", "unit_price": "9999999999999999.99", "discount_amount": "0.00"}
    changes = [{"order_id": f"N{n}", "line_id": str(n), "country": c, **high} for n in range(3) for c in ("PT", "NO")[: 3 - n]]
    lines = lines_of(spark, *changes)
    shares = spark.sql("SELECT DATE'2023-05-17' AS order_date, 5L AS shares")
    rows = {row.country: row for row in daily_sales(lines, shares).collect()}
    assert rows == {row.country: row for row in daily_sales(lines).collect()}
    assert rows["PT"].gross_amount is None and rows["PT"].order_count == 3
