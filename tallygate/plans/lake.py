"""Lake tables over all runs, parameterised SQL, and the reconciliation of a run."""

from __future__ import annotations

import re
from datetime import date
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tallygate.contract import DAILY_SALES, ORDER_LINES
from tallygate.operators.daily import summary
from tallygate.operators.quality import QualityError, checked_run_id
from tallygate.session import use_contract_time
from tallygate.sources import files
from tallygate.sources.runs import RunLayout, read_daily_sales, success_marker

# Fixed value: the form of a database or table name.
_NAME = re.compile(r"[a-z][a-z0-9_]{0,254}(\.[a-z][a-z0-9_]{0,254})?")
_PARTITIONS_PER_STATEMENT = 500


class UnsafeParameterError(ValueError):
    """A value that must not be put into a statement."""


def checked_name(value: str) -> str:
    if not isinstance(value, str) or not _NAME.fullmatch(value):
        raise UnsafeParameterError(f"not a table name: {value!r}")
    return value


def checked_location(value: str) -> str:
    """A path that can stand in quotes inside a statement."""
    if re.search(r"['\\`]", value):
        raise UnsafeParameterError(f"not a table location: {value!r}")
    return value


def run_sql(
    spark: SparkSession, text: str, tables: dict[str, str] | None = None, **values: Any
) -> DataFrame:
    """Run a statement with ``:name`` markers; tables are named by ``IDENTIFIER(:name)``.

    Spark binds the markers after parsing, so a value can never become SQL.  Table names
    and run ids are held to their forms on top of that.
    """
    if "run_id" in values:
        checked_run_id(values["run_id"])
    named = {name: checked_name(table) for name, table in (tables or {}).items()}
    return spark.sql(text, args={**named, **values})


_CREATE = """
CREATE TABLE IF NOT EXISTS IDENTIFIER(:target) ({columns})
USING parquet
PARTITIONED BY ({partitions})
LOCATION '{location}'
"""


def _columns(schema: Any) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_lake_tables(spark: SparkSession, database: str, root: str) -> None:
    """External tables ``order_lines`` and ``daily_sales`` over the runs below a root.

    Creating them again is harmless.  Name one ``run_id`` in every query: a run is a
    complete snapshot, so two runs together count the same lines twice.
    """
    checked_name(database)
    layout = RunLayout(root, "any")
    checked_location(layout.root)
    spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:name)", args={"name": database})
    tables = {
        "order_lines": (ORDER_LINES, "run_id, order_date", f"{layout.root}/silver/order_lines"),
        "daily_sales": (DAILY_SALES, "run_id", f"{layout.root}/gold/daily_sales"),
    }
    for name, (schema, partitions, location) in tables.items():
        text = _CREATE.format(
            columns=f"{_columns(schema)}, run_id string", partitions=partitions, location=location
        )
        run_sql(spark, text, {"target": f"{database}.{name}"})


def add_run(spark: SparkSession, database: str, root: str, run_id: str) -> None:
    """Make a published run visible in the lake tables; other runs are not looked at.

    A run has one daily-sales directory and one order-line directory per order date.  The
    contract's date range bounds their number; one listing names them and no file is opened.
    """
    layout = RunLayout(root, run_id)
    success_marker(spark, root, run_id)
    days = []
    if files.exists(spark, layout.order_lines):
        found = files.children(spark, layout.order_lines)
        days = [name.split("=", 1)[1] for name in found if name.startswith("order_date=")]
    spec = f"PARTITION (run_id = '{layout.run_id}'{{}})"
    parts = {
        "daily_sales": [spec.format("")],
        "order_lines": [spec.format(f", order_date = DATE '{date.fromisoformat(day)}'") for day in days],
    }
    for name, specs in parts.items():
        table = checked_name(f"{database}.{name}")
        for start in range(0, len(specs), _PARTITIONS_PER_STATEMENT):
            batch = " ".join(specs[start : start + _PARTITIONS_PER_STATEMENT])
            text = f"ALTER TABLE IDENTIFIER(:target) ADD IF NOT EXISTS {batch}"
            run_sql(spark, text, {"target": table})


def reconcile_run(spark: SparkSession, root: str, run_id: str) -> dict[str, Any]:
    """Compare the published daily sales with the run's own metrics, to the cent.

    Returns the summary of the data; raises ``QualityError`` if it differs or if any row
    breaks an invariant.
    """
    use_contract_time(spark)
    metrics = success_marker(spark, root, run_id)
    found = summary(read_daily_sales(spark, root, run_id)).first().asDict()
    agrees = (
        found["gold_rows"] == metrics["gold_rows"]
        and found["net_revenue"] == Decimal(metrics["net_amount"])
        and found["invalid_rows"] == 0
    )
    if not agrees:
        raise QualityError(f"Run {run_id} does not reconcile: {found} against {metrics}")
    return found
