from __future__ import annotations

from collections import Counter
from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest

from shapes import BOOK, CURRENT, SAMPLE, SAMPLE_DAILY, SAMPLE_NET, SAMPLE_REASONS, csv_line, day_of, totals, write_csv
from tallygate.contract import DAILY_SALES
from tallygate.operators import reports
from tallygate.operators.daily import consistent, summary
from tallygate.plans.lake import UnsafeParameterError, add_run, create_lake_tables, run_sql
from tallygate.plans.publish import publish_snapshot
from tallygate.sources.runs import read_daily_sales, read_order_lines, read_quarantine

D = Decimal


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    for run_id, lines in {"2026": SAMPLE, "other": [csv_line()]}.items():
        raw = write_csv(base / "raw" / run_id, "a.csv", lines)
        publish_snapshot(spark, raw, str(base), run_id, max_reject_ratio=0.4)
    return str(base)


def rows(frame):
    return [tuple(row) for row in frame.collect()]


def plan(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_lake_tables_show_one_run_and_prune_to_it(spark, lake):
    for _ in range(2):
        create_lake_tables(spark, "lake_test", lake)
        for run_id in ("2026", "other"):
            add_run(spark, "lake_test", lake, run_id)
    text = """
      SELECT order_date, count(DISTINCT order_id) AS orders FROM IDENTIFIER(:lines)
      WHERE run_id = :run_id AND order_date BETWEEN DATE '2024-06-05' AND DATE '2035-12-31'
      GROUP BY order_date
    """
    orders = run_sql(spark, text, {"lines": "lake_test.order_lines"}, run_id="2026")
    last = {row["order_id"] for row in CURRENT if day_of(row) == "2024-06-05"}
    assert rows(orders) == [(date(2024, 6, 5), len(last))]
    location = next(line for line in plan(orders).splitlines() if "Location" in line)
    assert "run_id=2026/order_date=2024-06-05" in location and "run_id=other" not in location
    sales = "SELECT sum(net_amount) FROM IDENTIFIER(:daily) WHERE run_id = :run_id"
    single = int(BOOK["quantity"]) * D(BOOK["unit_price"]) - D(BOOK["discount_amount"])
    for run_id, net in (("2026", SAMPLE_NET), ("other", single)):
        assert rows(run_sql(spark, sales, {"daily": "lake_test.daily_sales"}, run_id=run_id)) == [
            (net,)
        ]
    assert spark.table("lake_test.order_lines").schema["run_id"].dataType.simpleString() == "string"


@pytest.mark.parametrize("table", ["db; DROP TABLE x", "Db.t", "a.b.c", "", "t'", None])
def test_unsafe_table_names_are_refused(spark, table):
    with pytest.raises(UnsafeParameterError):
        run_sql(spark, "SELECT 1 FROM IDENTIFIER(:t)", {"t": table})


def test_unsafe_values_are_refused_or_stay_values(spark):
    with pytest.raises(ValueError, match="run_id"):
        run_sql(spark, "SELECT :run_id", run_id="x' OR '1'='1")
    assert rows(run_sql(spark, "SELECT :word AS w", word="'; DROP TABLE x; --")) == [
        ("'; DROP TABLE x; --",)
    ]
    with pytest.raises(UnsafeParameterError):
        create_lake_tables(spark, "fine", "/tmp/it's")


def test_run_readers_read_one_run_and_only_needed_columns(spark, lake):
    narrow = read_order_lines(spark, lake, "2026").filter("order_date = '2024-06-03'").select(
        "order_id"
    )
    text = plan(narrow)
    assert "ReadSchema: struct<order_id:string>" in text
    assert "PartitionFilters: [isnotnull(order_date" in text
    assert narrow.count() == sum(day_of(row) == "2024-06-03" for row in CURRENT)
    assert read_daily_sales(spark, lake, "2026").select("run_id").distinct().first()[0] == "2026"


def day(row):
    return date.fromisoformat(day_of(row))


def test_sales_by_day_and_country(spark, lake):
    daily = read_daily_sales(spark, lake, "2026")
    wanted = totals(CURRENT, lambda r: (day(r), r["country"]))
    assert rows(reports.sales_by_day_country(daily)) == [(*k, s[5], s[2]) for k, s in sorted(wanted.items())]


def test_orders_by_day_counts_orders_once_and_cancelled_lines(spark, lake):
    lines = read_order_lines(spark, lake, "2026")
    money = totals(CURRENT, day)
    wanted = []
    for when in sorted({day(r) for r in CURRENT}):
        own = [r for r in CURRENT if day(r) == when]
        wanted.append((when, len({r["order_id"] for r in own}), len(own), money[when][5]))
    assert rows(reports.orders_by_day(lines)) == wanted


def percent(part, whole):
    return (100 * part / whole).quantize(D("0.01"), ROUND_HALF_UP)


def test_category_reports(spark, lake):
    daily = read_daily_sales(spark, lake, "2026")
    pairs = totals(CURRENT, lambda r: (r["country"], r["category"]))
    wanted = [(*k, s[5], s[4], percent(s[4], s[3])) for k, s in pairs.items()]
    assert rows(reports.category_performance(daily)) == sorted(wanted, key=lambda r: (r[0], -r[2]))
    categories = totals(CURRENT, lambda r: r["category"])
    wanted = [(k, s[5], percent(s[5], SAMPLE_NET)) for k, s in categories.items()]
    assert rows(reports.category_revenue_share(daily)) == sorted(wanted, key=lambda r: -r[1])
    days = totals(CURRENT, day)
    assert rows(reports.sales_by_day(daily)) == [(k, s[1], s[2], s[5]) for k, s in sorted(days.items())]


def test_shares_of_nothing_are_null(spark):
    free = spark.createDataFrame(
        [(date(2024, 3, 8), "JP", "Gifts", 1, 1, 1, D(0), D(0), D(0))], DAILY_SALES
    )
    assert reports.category_performance(free).first().discount_percent is None
    assert reports.category_revenue_share(free).first().revenue_share_percent is None
    assert reports.category_revenue_share(free.filter("false")).count() == 0


def test_the_revenue_share_never_gathers_all_rows_in_one_window(spark, lake):
    text = plan(reports.category_revenue_share(read_daily_sales(spark, lake, "2026")))
    assert "Window" not in text


def test_rejects_by_reason(spark, lake):
    counts = rows(reports.rejects_by_reason(read_quarantine(spark, lake, "2026")))
    wanted = Counter(reason for reasons in SAMPLE_REASONS.values() for reason in reasons)
    assert counts == sorted(wanted.items(), key=lambda x: (-x[1], x[0]))


SOUND = (date(2024, 3, 8), "NO", "Lamps", 2, 3, 4, D("14.40"), D("2.15"), D("12.25"))


@pytest.mark.parametrize("at, value", [
    *((n, None) for n in range(9)),
    (3, 0), (4, 0), (5, 0), (3, 4), (4, 5), (6, D("-1")), (7, D("-1")), (8, D("-9")),
    (8, D("12.24")),
])
def test_each_broken_invariant_is_counted(spark, at, value):
    broken = tuple(value if n == at else v for n, v in enumerate(SOUND))
    nullable = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DAILY_SALES)
    daily = spark.createDataFrame([SOUND, broken], nullable)
    assert daily.filter(consistent()).count() == 1
    assert summary(daily).first().invalid_rows == 1


def test_the_summary_of_nothing_is_zero(spark):
    empty = spark.createDataFrame([], DAILY_SALES)
    assert rows(summary(empty)) == [(0, 0, 0, D("0.00"), 0)]


def test_the_daily_mart_shuffles_partial_results_only(spark, lake):
    from tallygate.operators.daily import daily_sales

    text = plan(daily_sales(read_order_lines(spark, lake, "2026").drop("run_id")))
    assert text.count("Exchange") and "partial_count" in text
    assert "customer_id" not in text.split("ReadSchema")[1].splitlines()[0]
