"""The snapshot contract: column names, types and limits of every dataset.

Nothing in the engine infers a schema.  Every reader and writer takes its columns
from here, and the order of the columns is part of the contract because mart loads
are positional.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

MONEY = DecimalType(18, 2)

_TYPES: dict[str, DataType] = {
    "text": StringType(),
    "int": IntegerType(),
    "long": LongType(),
    "double": DoubleType(),
    "money": MONEY,
    "instant": TimestampType(),
    "day": DateType(),
    "texts": ArrayType(StringType(), containsNull=False),
}


def _table(**columns: str) -> StructType:
    return StructType([StructField(name, _TYPES[kind]) for name, kind in columns.items()])


# The twelve source columns, in file order.
SOURCE_COLUMNS = (
    "order_id",
    "line_id",
    "customer_id",
    "product_id",
    "category",
    "country",
    "quantity",
    "unit_price",
    "discount_amount",
    "order_timestamp",
    "updated_at",
    "status",
)

# Names of the provenance columns.
CORRUPT = "_corrupt_record"
SOURCE_FILE = "_source_file"
RECORD_HASH = "_record_hash"

SOURCE = _table(**dict.fromkeys(SOURCE_COLUMNS, "text"), **{CORRUPT: "text", SOURCE_FILE: "text"})

ORDER_LINES = _table(
    order_id="text",
    line_id="text",
    customer_id="text",
    product_id="text",
    category="text",
    country="text",
    quantity="int",
    unit_price="money",
    discount_amount="money",
    order_timestamp="instant",
    updated_at="instant",
    status="text",
    gross_amount="money",
    net_amount="money",
    order_date="day",
    _record_hash="text",
    _source_file="text",
)

SUPERSEDED = StructType([*ORDER_LINES.fields, *_table(dedup_rank="int").fields])

QUARANTINE = _table(
    **dict.fromkeys(SOURCE_COLUMNS, "text"),
    _corrupt_record="text",
    _source_file="text",
    _record_hash="text",
    validation_errors="texts",
)

DAILY_SALES = _table(
    order_date="day",
    country="text",
    category="text",
    order_count="long",
    line_count="long",
    units="long",
    gross_amount="money",
    discount_amount="money",
    net_amount="money",
)

MART = StructType(
    [*DAILY_SALES.fields, *_table(source_run_id="text", loaded_at="instant").fields]
)

LOAD_AUDIT = _table(run_id="text", loaded_at="instant", row_count="long")

RUN_METRICS = _table(
    run_id="text",
    input_rows="long",
    rejected_rows="long",
    duplicate_rows="long",
    valid_rows="long",
    gold_rows="long",
    reject_ratio="double",
    net_amount="text",
)


@dataclass(frozen=True)
class Limits:
    """Value limits of the contract; the defaults are fixed values of the data contract."""

    first_order_date: str = "2020-01-01"
    last_order_date: str = "2035-12-31"
    category_bytes: int = 100
    statuses: tuple[str, ...] = ("COMPLETED", "CANCELLED")
    timestamp_format: str = "yyyy-MM-dd'T'HH:mm:ss"

    def order_days(self) -> int:
        """Number of dates an order can have."""
        first, last = map(date.fromisoformat, (self.first_order_date, self.last_order_date))
        return (last - first).days + 1


DEFAULT_LIMITS = Limits()
