from __future__ import annotations

import hashlib
import json
import re
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shapes import BOOK, frame
from tallygate.contract import ORDER_LINES, QUARANTINE, SOURCE_COLUMNS, Limits
from tallygate.functions.rules import Rule, contract_rules, required
from tallygate.operators.classify import accepted_lines, classify, rejected_rows

LIMITS = Limits()
GROSS = Decimal(BOOK["quantity"]) * Decimal(BOOK["unit_price"])
FIRST, LAST = (datetime.fromisoformat(day) for day in (LIMITS.first_order_date, LIMITS.last_order_date))
MOST_MONEY = Decimal(10) ** 16 - Decimal("0.01")


def at(moment, column="order_timestamp"):
    text = moment.isoformat(timespec="seconds")
    return {column: text} | ({"updated_at": text} if column == "order_timestamp" else {})


# For each rule the last value it accepts and the first one that breaks it, with all reasons.
BOUNDARIES = [
    ({"order_id": "."}, {"order_id": "   "}, ["missing_order_id"]),
    ({"line_id": "0"}, {"line_id": ""}, ["missing_line_id"]),
    ({"customer_id": "\t"}, {"customer_id": None}, ["missing_customer_id"]),
    ({"product_id": "p"}, {"product_id": " "}, ["missing_product_id"]),
    ({"category": "c"}, {"category": "  "}, ["missing_category"]),
    ({"category": "ø" * (LIMITS.category_bytes // 2)}, {"category": "ø" * (LIMITS.category_bytes // 2) + "c"}, ["category_too_long"]),
    ({"country": " jp "}, {"country": "j"}, ["invalid_country"]),
    ({"country": "ZZ"}, {"country": "ZÅ"}, ["invalid_country"]),
    ({"quantity": "0004"}, {"quantity": "4 "[:1] + "\n"}, ["invalid_quantity"]),
    ({"quantity": str(2**31 - 1)}, {"quantity": str(2**31)}, ["invalid_quantity"]),
    ({"quantity": "1"}, {"quantity": "-1"}, ["invalid_quantity", "discount_exceeds_gross"]),
    ({"unit_price": "7.3"}, {"unit_price": "7."}, ["invalid_unit_price"]),
    ({"unit_price": "8.25"}, {"unit_price": "8.250"}, ["invalid_unit_price"]),
    ({"unit_price": "9"}, {"unit_price": "+9"}, ["invalid_unit_price"]),
    ({"quantity": "1", "unit_price": str(MOST_MONEY)}, {"quantity": "1", "unit_price": str(int(MOST_MONEY) + 1)}, ["invalid_unit_price"]),
    ({"discount_amount": "0"}, {"discount_amount": ""}, ["invalid_discount_amount", "amount_overflow"]),
    ({"discount_amount": str(GROSS)}, {"discount_amount": str(GROSS + Decimal("0.01"))}, ["discount_exceeds_gross"]),
    (at(FIRST), at(FIRST - timedelta(seconds=1)), ["order_date_out_of_range"]),
    (at(LAST + timedelta(hours=23, minutes=59, seconds=59)), at(LAST + timedelta(days=1)), ["order_date_out_of_range"]),
    (at(datetime(2024, 2, 29, 1, 2, 3)), {"order_timestamp": "2023-02-29T01:02:03"}, ["invalid_order_timestamp"]),
    ({}, {"order_timestamp": BOOK["order_timestamp"] + ".0"}, ["invalid_order_timestamp"]),
    ({"updated_at": "2031-10-11T12:13:14"}, {"updated_at": "2031-10-11 12:13:14"}, ["invalid_updated_at"]),
    ({"updated_at": BOOK["order_timestamp"]}, at(datetime.fromisoformat(BOOK["order_timestamp"]) - timedelta(seconds=1), "updated_at"), ["updated_before_order"]),
    ({"status": "Cancelled"}, {"status": "CANCELED"}, ["invalid_status"]),
    ({"quantity": "1", "unit_price": "7500000000000000.5"}, {"quantity": "2", "unit_price": "7500000000000000.5"}, ["amount_overflow"]),
]
BROKEN = [(bad, reasons) for _, bad, reasons in BOUNDARIES]


def test_every_defect_is_reported_with_all_its_reasons(spark):
    changes = [change for change, _ in BROKEN]
    marked = frame(spark, *changes).coalesce(1).withColumn(
        "_source_file", F.monotonically_increasing_id().cast("string")
    )
    classified = classify(marked)
    found = {
        int(row._source_file): row.validation_errors for row in rejected_rows(classified).collect()
    }
    assert [found.get(at) for at in range(len(BROKEN))] == [reasons for _, reasons in BROKEN]
    assert accepted_lines(classified).count() == 0


def test_values_at_the_edge_of_the_contract_pass(spark):
    edge = frame(spark, *(good for good, _, _ in BOUNDARIES))
    assert accepted_lines(classify(edge)).count() == len(BOUNDARIES)


def test_values_are_trimmed_upper_cased_and_exact(spark):
    padded = {
        "order_id": "  N8",
        "country": "no  ",
        "status": "  Completed",
        "quantity": "7",
        "unit_price": "0.29",
        "discount_amount": "1.1",
    }
    row = accepted_lines(classify(frame(spark, padded))).withColumn(
        "shown", F.date_format("order_timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    ).first()
    assert (row.order_id, row.country, row.status) == ("N8", "NO", "COMPLETED")
    gross = 7 * Decimal("0.29")
    assert (row.gross_amount, row.net_amount) == (gross, gross - Decimal("1.10"))
    assert row.order_date.isoformat() == BOOK["order_timestamp"][:10]
    assert row.shown == BOOK["order_timestamp"]


def test_only_spaces_are_trimmed(spark):
    row = accepted_lines(classify(frame(spark, {"order_id": "\tN1 "}))).first()
    assert row.order_id == "\tN1"


def test_cancelled_lines_keep_price_and_discount_but_no_money(spark):
    row = accepted_lines(classify(frame(spark, {"status": "cancelled"}))).first()
    assert (row.gross_amount, row.net_amount) == (Decimal("0.00"), Decimal("0.00"))
    assert (row.unit_price, row.discount_amount) == (Decimal(BOOK["unit_price"]), Decimal(BOOK["discount_amount"]))


def test_record_hash_covers_the_normalised_values_with_nulls(spark):
    row = classify(frame(spark, {"country": " no", "category": None})).first()
    values = {**BOOK, "country": "NO", "category": None}
    text = json.dumps({name: values[name] for name in SOURCE_COLUMNS}, separators=(",", ":"))
    assert row._record_hash == hashlib.sha256(text.encode()).hexdigest()


def test_schemas_hold_for_an_empty_frame(spark):
    classified = classify(frame(spark, {}).filter("false"))
    types = [(f.name, f.dataType) for f in accepted_lines(classified).schema]
    assert types == [(f.name, f.dataType) for f in ORDER_LINES]
    types = [(f.name, f.dataType) for f in rejected_rows(classified).schema]
    assert types == [(f.name, f.dataType) for f in QUARANTINE]
    assert accepted_lines(classified).count() == rejected_rows(classified).count() == 0


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="Missing required source columns: quantity, status"):
        classify(frame(spark, {}).drop("status", "quantity"))


def test_rules_and_limits_can_be_replaced(spark):
    early = Limits(first_order_date="2019-01-01")
    old = frame(spark, {"order_timestamp": "2019-06-01T00:00:00"})
    assert accepted_lines(classify(old, limits=early)).count() == 1
    rules = [*contract_rules(), required("no_lamp", F.col("category") == "Lamps")]
    classified = classify(frame(spark, {"category": "Toys"}), rules)
    assert rejected_rows(classified).first().validation_errors == ["no_lamp"]


def test_any_number_of_rules_is_told_apart(spark):
    rules = [Rule(f"r{n}", F.col("quantity") == str(n)) for n in range(130)]
    for n in (0, 62, 63, 64, 129):
        classified = classify(frame(spark, {"quantity": str(n)}), rules)
        assert rejected_rows(classified).first().validation_errors == [f"r{n}"]
    assert accepted_lines(classify(frame(spark, {"quantity": "130"}), rules)).count() == 1
    assert accepted_lines(classify(frame(spark, {"quantity": "x"}), [])).count() == 1


def test_compiled_methods_stay_small_enough_for_the_jvm(spark):
    """The JVM leaves methods of 8,000 bytes and more uncompiled."""
    from harness.queries import rows_as_landed

    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the plan is not yet compiled
    try:
        judged = classify(rows_as_landed(spark, "/root/testdata/sf0.001"))
        for result in (judged.select("_record_hash", "accepted"), rejected_rows(judged), accepted_lines(judged)):
            text = result._jdf.queryExecution().explainString(
                spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
            )
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
            assert sizes and max(sizes) < 8000, max(sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("form", [LIMITS.timestamp_format, "yyyy-dd-MM'T'HH:mm:ss"])
def test_times_are_cast_only_where_the_format_reads_the_same(spark, form):
    texts = [
        "2024-02-29T23:59:59", "2023-02-29T00:00:00", "0000-01-01T00:00:00", "0001-01-01T00:00:00", "1582-10-10T01:02:03",
        "9999-12-31T23:59:59", "2024-06-05T24:00:00", "2024-06-05T23:59:60", "2024-13-01T00:00:00", "2024-6-5T1:2:3",
        "+2024-6-5T01:02:03", "+12024-06-05T01:02:03", "2024-06-05 01:02:03", "2024-06-05T01:02:03Z", "2024-06-05T01:02",
        "2024-06-05", "٢٠٢٤-06-05T01:02:03", "2024-06-05T01:02:03\n", "", "epoch", None,
    ]
    rows = classify(frame(spark, *({"order_timestamp": text} for text in texts)), limits=Limits(timestamp_format=form))
    by_format = F.try_to_timestamp("order_timestamp", F.lit(form))
    assert rows.filter(~F.col("typed_order_timestamp").eqNullSafe(by_format)).count() == 0
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert ("cast(order_timestamp" in plan) == (form == LIMITS.timestamp_format)


def test_a_filter_on_the_outcome_does_not_parse_rows_twice(spark):
    plan = accepted_lines(classify(frame(spark, {})))._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    assert text.count("gettimestamp") == 2
    assert text.count("StructsToJson") == 1
