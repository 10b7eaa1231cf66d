"""Order-line snapshot built from the supplied star-schema tables.

Each line item is one version of an order line.  Its text form goes through the same
contract as a CSV row.  Lines of the small parts (`p_size` up to 24) taxed at 0.00 or
0.04 get one defect each, chosen by `p_size`, so that every validation rule fires.
"""

from __future__ import annotations

from contextlib import AbstractContextManager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygate.functions.rules import computed_once
from tallygate.session import settings, shuffles_for
from tallygate.sources import files

# Which defect a part size stands for, as (column, broken text).
DEFECTS = {
    1: ("order_id", "'  '"),
    2: ("line_id", "''"),
    3: ("customer_id", "' '"),
    4: ("product_id", "''"),
    5: ("category", "''"),
    6: ("category", "repeat('é', 51)"),
    7: ("country", "'q7'"),
    8: ("quantity", "'6 pcs'"),
    9: ("quantity", "'000'"),
    10: ("quantity", "'31000000000'"),
    11: ("unit_price", "'7,40'"),
    12: ("unit_price", "'88.125'"),
    13: ("unit_price", "'0x1F'"),
    14: ("unit_price", "CASE quantity WHEN '1' THEN unit_price ELSE '9999999999999999.99' END"),
    15: ("discount_amount", "'12%'"),
    16: ("discount_amount", "'73000000.5'"),
    17: ("order_timestamp", "'24/06/2021 18:05'"),
    18: ("order_timestamp", "'2011-07-04T06:20:30'"),
    19: ("order_timestamp", "'2052-11-08T16:40:10'"),
    20: ("updated_at", "'2027-04-31T12:12:12'"),
    21: ("updated_at", "'2013-05-06T07:08:09'"),
    22: ("status", "'on hold'"),
}
# Sizes 23 and 24 break the line itself: one field too many, and an open quote.
EXTRA_FIELD, OPEN_QUOTE = 23, 24

# The same text runs in Spark and in DuckDB but for the way a timestamp is printed and the order of joins.
VERSIONS = """
SELECT
  {order_id} AS order_id,
  {line_id} AS line_id,
  {customer_id} AS customer_id,
  {product_id} AS product_id,
  {category} AS category,
  {country} AS country,
  {quantity} AS quantity,
  {unit_price} AS unit_price,
  {discount_amount} AS discount_amount,
  {order_timestamp} AS order_timestamp,
  {updated_at} AS updated_at,
  {status} AS status,
  CASE WHEN flaw = 23 THEN 'extra' WHEN flaw = 24 THEN 'quote' END AS damage
FROM (
  SELECT
    concat('O', CAST(l_orderkey AS {text})) AS order_id,
    CAST(l_linenumber AS {text}) AS line_id,
    concat('C', CAST(o_custkey AS {text})) AS customer_id,
    concat('P', CAST(l_partkey AS {text})) AS product_id,
    concat(p_type, CASE WHEN p_size > 40 THEN ', large' ELSE '' END) AS category,
    concat(' ', chr(97 + n_regionkey), chr(97 + n_nationkey)) AS country,
    CAST(CAST(l_quantity AS INTEGER) AS {text}) AS quantity,
    CAST(CAST(p_retailprice AS DECIMAL(18, 2)) AS {text}) AS unit_price,
    CAST(CAST(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(18, 2))
      * CAST(abs(l_discount) AS DECIMAL(4, 2)) AS DECIMAL(18, 2)) AS {text}) AS discount_amount,
    {ordered} AS order_timestamp,
    {updated} AS updated_at,
    CASE WHEN l_returnflag = 'R' THEN 'cancelled' ELSE 'Completed' END AS status,
    CASE WHEN p_size <= 24 AND CAST(l_tax AS DECIMAL(4, 2)) IN (0.00, 0.04) THEN p_size
      ELSE 0 END AS flaw
  FROM {lineitem}
  {joined}
) AS sound
"""

# The same joins, in an order for each engine. Spark joins in the order of the text: customers go to
# the orders first, so that the many rows of line items are shuffled by two keys and not by three.
JOINED = {
    "duckdb": """JOIN {orders} ON l_orderkey = o_orderkey
  JOIN {part} ON l_partkey = p_partkey
  JOIN {customer} ON o_custkey = c_custkey
  JOIN {nation} ON c_nationkey = n_nationkey""",
    "spark": """JOIN (
    SELECT o_orderkey, o_custkey, o_orderdate, c_nationkey
    FROM {orders}
    JOIN {customer} ON o_custkey = c_custkey
  ) AS ordered ON l_orderkey = o_orderkey
  JOIN {part} ON l_partkey = p_partkey
  JOIN {nation} ON c_nationkey = n_nationkey""",
}

TABLES = ("lineitem", "orders", "part", "customer", "nation")


def versions_sql(dialect: str, tables: dict[str, str]) -> str:
    """The snapshot as SQL text for one of the two engines."""
    shipped = "greatest(l_shipdate, o_orderdate) + INTERVAL '25' YEAR"
    ordered = "o_orderdate + INTERVAL '25' YEAR"
    if dialect == "spark":
        text, stamp = "STRING", "date_format({}, \"yyyy-MM-dd'T'HH:mm:ss\")"
    else:
        text, stamp = "VARCHAR", "strftime({}, '%Y-%m-%dT%H:%M:%S')"
    columns = {}
    for column in dict(DEFECTS.values()):
        broken = " ".join(
            f"WHEN {size} THEN {value}" for size, (name, value) in DEFECTS.items() if name == column
        )
        columns[column] = f"CASE flaw {broken} ELSE {column} END"
    return VERSIONS.format(
        text=text,
        ordered=stamp.format(ordered),
        updated=stamp.format(shipped),
        joined=JOINED[dialect].format(**tables),
        **columns,
        **tables,
    )


def order_line_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve text columns of every version, and how its CSV line is damaged, if at all."""
    text = versions_sql("spark", {name: f"{{{name}}}" for name in TABLES})
    frames = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in TABLES}
    # Tied to the task, so the contract's rules stay in a projection, and compiled code, of their own.
    return spark.sql(text, **frames).withColumn("damage", computed_once(F.col("damage")))


# Bytes that a line item takes as rows of a join, for each of its bytes on storage.
_UNPACKED = 8


def roomy_joins(spark: SparkSession, sf_dir: str) -> AbstractContextManager[None]:
    """Enough shuffle partitions for an action on ``order_line_versions`` that no task has to spill."""
    size = _UNPACKED * files.size(spark, f"{sf_dir}/lineitem.parquet")
    return settings(spark, shuffles_for(spark, size))
